import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewick.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    return session


def minute(n: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=n)


def bars(spark, rows, symbol="A"):
    """rows of (minute, price) or (minute, open, high, low, close, volume)."""
    full = [(symbol, minute(r[0]), *((r[1],) * 4 if len(r) == 2 else r[1:5]), 1.0 if len(r) == 2 else r[5], T0) for r in rows]
    return spark.createDataFrame(
        [tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in f) for f in full],
        "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double, ingested_at timestamp_ntz")
