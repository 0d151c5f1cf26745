"""Run catalogued queries and their SQL side by side: python -m checks.compare SF [name-part ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import catalog
from tidewick.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
         "date": "DATE", "array<double>": "DOUBLE[]"}


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return tuple(v) if isinstance(v, list) else v


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def run(sf_dir: str, wanted: list[str]) -> int:
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for key, make in catalog.QUERIES.items():
        if wanted and not any(w in key for w in wanted):
            continue
        began = time.time()
        try:
            df = make(spark, sf_dir)
            cols = sorted(df.columns)
            mine = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
            took = time.time() - began
            if key not in catalog.ORACLES:
                print(f"rows  {key}: {len(mine)} rows {took:.1f}s", flush=True)
                continue
            began = time.time()
            rel = db.sql(catalog.ORACLES[key])
            kinds = dict(zip(rel.columns, map(str, rel.types)))
            theirs = [tuple(plain(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall()] if sorted(rel.columns) == cols else None
            sql_took = time.time() - began
            odd = {c: (t, kinds.get(c)) for c, t in df.dtypes if KINDS.get(t) != kinds.get(c)}
            if theirs is None:
                verdict = f"COLUMNS {set(cols) ^ set(rel.columns)}"
            elif order(mine) == order(theirs):
                verdict = "ok" if not odd else f"TYPES {odd}"
            else:
                a, b = set(mine), set(theirs)
                verdict = f"DIFF {len(mine)} vs {len(theirs)} rows; only spark {list(order(a - b))[:2]} only sql {list(order(b - a))[:2]} n={len(a - b)},{len(b - a)} types {odd}"
            bad += verdict != "ok"
            print(f"{verdict[:900]:5} {key}: {len(mine)} rows spark {took:.1f}s sql {sql_took:.1f}s", flush=True)
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {key}: {type(exc).__name__} {str(exc)[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(min(run(f"/root/testdata/sf{sys.argv[1]}", sys.argv[2:]), 1))
