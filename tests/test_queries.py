"""Every catalogued query against its SQL on the smallest data set, and plan checks."""

import duckdb
import pytest

from checks import catalog
from checks.compare import KINDS, TABLES, order, plain
from tests.conftest import SF

# Trained models and the widest pipelines run in checks.compare and test_lake instead.
HEAVY = {"s6_gold_snapshot", "st7_stream_publish", "m3_boosted_regression", "m4_recursive_forecast", "m5_published_with_band", "m6_warning_classifier",
         "m7_scored_warnings", "m8_direction_experiment", "m9_anomaly_scores"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", [k for k in catalog.ORACLES if k not in HEAVY])
def test_query_equals_sql(spark, db, key):
    df = catalog.QUERIES[key](spark, SF)
    rel = db.sql(catalog.ORACLES[key])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    mine = order([tuple(plain(r[c]) for c in cols) for r in df.collect()])
    at = [rel.columns.index(c) for c in cols]
    assert mine == order([tuple(plain(r[i]) for i in at) for r in rel.fetchall()])


@pytest.mark.parametrize("key", ["flagship_gold_events", "silver_features", "j1_peak_range_join", "j4_concurrent_symbols_market", "j5_event_candles",
                                 "a23_error_band", "q12_price_board", "q14_correlation_matrix", "t6_hash_sample"])
def test_no_cross_or_nested_loop_joins(spark, key):
    plan = catalog.QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = catalog.QUERIES["w1_latest_wins"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "user_id" not in plan
