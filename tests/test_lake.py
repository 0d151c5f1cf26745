import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, T0, bars, minute
from tidewick.config import Settings
from tidewick.learning import registry, runs
from tidewick.operators import candles
from tidewick.plans import ingest, lakehouse, serving
from tidewick.schemas import SCHEMAS
from tidewick.session import fresh_path, shared_dir
from tidewick.sources import bindings as B, payloads
from tidewick.sources.lake import LakeTables, export_csv
from tidewick.streaming import jobs


@pytest.fixture()
def lake(spark):
    return LakeTables(spark, fresh_path(spark, "lake"))


@pytest.mark.parametrize("table", sorted(SCHEMAS))
def test_missing_table_reads_as_empty(lake, table):
    assert lake.read(table).count() == 0


def test_refresh_without_input_is_quiet(lake):
    lakehouse.refresh_silver(lake)
    assert lakehouse.refresh_gold(lake) == {}


def test_payloads_without_candles(spark):
    bad = [("A", '{"s":"no_data","t":[1],"o":[1],"h":[1],"l":[1],"c":[1],"v":[1]}'), ("A", '{"s":"ok","t":[],"o":[],"h":[],"l":[],"c":[],"v":[]}'), ("A", "oops")]
    good = [("B", '{"s":"ok","t":[1704067200,1704067260],"o":[1,2],"h":[3,4],"l":[1,1],"c":[2,3],"v":[5,6]}')]
    df = spark.createDataFrame(bad + good, "symbol string, body string")
    got = payloads.candles_from_payload(df).orderBy("ts").collect()
    assert [(r["symbol"], r["ts"], r["close"], r["volume"]) for r in got] == [("B", T0, 2.0, 5.0), ("B", minute(1), 3.0, 6.0)]


def test_absent_ticker_numbers_become_zero(spark):
    df = spark.createDataFrame([('[{"symbol":"A_THB","last":"3.5"},{"symbol":"B_THB","quote_volume":"x"}]',)], "body string")
    got = {r["symbol"]: r for r in payloads.ticker_from_payload(df, F.lit(T0)).collect()}
    assert got["A_THB"]["last"] == 3.5 and got["A_THB"]["percent_change"] == 0 and got["B_THB"]["volume_thb_24h"] == 0


def test_chunked_ranges(spark):
    now = dt.datetime(2024, 6, 1)
    now_s = int(now.replace(tzinfo=dt.timezone.utc).timestamp())
    pairs = spark.createDataFrame([("A", True), ("B", True), ("C", False)], "symbol string, selected boolean")
    state = spark.createDataFrame([("A", now_s - 65 * 86400), ("B", now_s)], "symbol string, last_ts long")
    got = ingest.pull_ranges(pairs, state, now).orderBy("from_s").collect()
    assert [(r["symbol"], (r["to_s"] - r["from_s"]) // 86400) for r in got] == [("A", 30), ("A", 30), ("A", 5)]


def test_upsert_replaces_and_accumulates(spark):
    schema = "k string, a int, n int"
    old, new = spark.createDataFrame([("x", 1, 10), ("y", 2, 20)], schema), spark.createDataFrame([("y", None, 5), ("z", 3, 1)], schema)
    got = sorted(map(tuple, ingest.upsert(old, new, ["k"], ["a"], ["n"]).collect()))
    assert got == [("x", 1, 10), ("y", None, 25), ("z", 3, 1)]


def test_replace_reads_its_own_previous_version(spark, lake):
    rows = spark.createDataFrame([("a", T0, 1), ("b", T0, 2)], "symbol string, hour_utc timestamp_ntz, candles long")
    rows = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None).cast("double").alias(c)) for c in lake.empty("symbol_hourly").columns])
    assert lake.replace("symbol_hourly", rows) == 2
    assert lake.replace("symbol_hourly", lake.read("symbol_hourly").where("candles > 1")) == 1
    assert [r["symbol"] for r in lake.read("symbol_hourly").collect()] == ["b"]


def hours(spark, lake, *counts):
    rows = spark.createDataFrame([(str(n), T0, n) for n in counts] or [("", T0, 0)], "symbol string, hour_utc timestamp_ntz, candles long").where("candles > 0")
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None).cast("double").alias(c)) for c in lake.empty("symbol_hourly").columns])


def test_two_writers_lose_no_change(spark, lake):
    """Another writer replaces the table while the first one computes: the step runs again on that version."""
    lake.replace("symbol_hourly", hours(spark, lake, 1))
    seen = []

    def step(old):
        seen.append(old.count())
        if len(seen) == 1:
            lake.replace("symbol_hourly", hours(spark, lake, 1, 2))
        return old.unionByName(hours(spark, lake, 3))

    assert lake.update("symbol_hourly", step) == 3 and seen == [1, 2]
    assert sorted(r["candles"] for r in lake.read("symbol_hourly").collect()) == [1, 2, 3]
    assert lake.current("symbol_hourly")[0] == 2


def test_pointer_number_is_taken_once(lake):
    assert lake._point("pairs", 0, "a") and not lake._point("pairs", 0, "b")
    assert lake.current("pairs") == (0, "a")


def test_scan_of_one_folder_and_its_row_groups(spark, lake):
    rows = bars(spark, [(m, 1 + m) for m in range(50)]).unionByName(bars(spark, [(0, 7)], "B"))
    lake.replace_slices("bronze_candles", rows, sort=["ts"])
    got = lake.read_slice("bronze_candles", "symbol", "A", F.col("ts") >= F.lit(minute(40)).cast("timestamp_ntz"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "GreaterThanOrEqual(ts" in plan
    assert got.count() == 10 and len(got.inputFiles()) >= 1
    assert lake.read_slice("bronze_candles", "symbol", "C").count() == 0
    assert lake.read_slice("silver_features", "symbol", "A").count() == 0


def ingest_once(spark, lake, run_id, now, bodies):
    """A run over given bodies by symbol."""
    tick = spark.createDataFrame([('[{"symbol":"A_THB","quote_volume":"5"},{"symbol":"B_THB","quote_volume":"0"}]',)], "body string")
    listing = spark.createDataFrame([], "symbol string, name string, listed_at timestamp_ntz")
    answer = spark.createDataFrame(bodies or [("", "")], "symbol string, body string")
    fetch = lambda ranges: ranges.groupBy("symbol").count().drop("count").join(answer, "symbol")
    return ingest.run(lake, run_id, now, tick, listing, fetch)


BODY = '{"s":"ok","t":[%s],"o":[1%s],"h":[1%s],"l":[1%s],"c":[1%s],"v":[1%s]}'


def body(*seconds):
    return BODY % (",".join(map(str, seconds)), *[",1" * (len(seconds) - 1)] * 5)


def test_repeated_ingest_run_changes_nothing(spark, lake):
    first = [("A_THB", body(1704067200, 1704067260)), ("B_THB", body(1704067200))]
    assert ingest_once(spark, lake, "r1", minute(10), first)
    assert not ingest_once(spark, lake, "r1", minute(10), first)
    assert ingest_once(spark, lake, "r2", minute(20), [("A_THB", body(1704067260, 1704067800))])
    state = [(r["symbol"], r["last_ts"], r["rows_total"], r["files"]) for r in lake.read("ingest_state").collect()]
    assert state == [("A_THB", 1704067800, 4, 2)]  # B_THB wasn't traded, so it isn't pulled
    assert lake.read("bronze_candles").count() == 4 and lake.read("bronze_ticker").count() == 4
    log = lake.read("ingest_log").orderBy("run_at").collect()
    assert [(r["rows"], r["api_calls"], r["is_backfill"]) for r in log] == [(2, 13, True), (2, 1, False)]
    assert candles.latest_candles(lake.read("bronze_candles")).count() == 3


def test_cut_off_run_is_invisible_and_done_anew(spark, lake, monkeypatch):
    """Rows of a run without a commit aren't read; the repeated run replaces them."""
    def stop(*args):
        raise OSError("lost")

    first = [("A_THB", body(1704067200, 1704067260))]
    with monkeypatch.context() as m:
        m.setattr(lake, "_point", lambda table, *rest: stop() if table == "ingest_state" else LakeTables._point(lake, table, *rest))
        with pytest.raises(OSError):
            ingest_once(spark, lake, "r1", minute(10), first)
    assert lake.exists(lake.path("bronze_candles_runs")) and lake.read("bronze_candles").count() == 0 and lake.read("ingest_state").count() == 0
    assert ingest_once(spark, lake, "r1", minute(10), first)
    assert lake.read("bronze_candles").count() == 2 and [r["rows_total"] for r in lake.read("ingest_state").collect()] == [2]


def test_ingest_run_without_candles(spark, lake):
    assert ingest_once(spark, lake, "r0", minute(10), [])
    assert lake.read("ingest_state").count() == lake.read("bronze_candles").count() == lake.read("ingest_log").count() == 0
    assert lake.committed_runs() == ["r0"] and not ingest_once(spark, lake, "r0", minute(10), [])


def test_csv_empty_cells_and_order(spark):
    path = fresh_path(spark, "csv")
    export_csv(spark.createDataFrame([(None, 2.5, T0)], "a string, b double, c timestamp_ntz").coalesce(1), ["c", "a", "b"], path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == ["c,a,b", "2024-01-01T00:00:00,,2.5"]


def test_tracked_symbol_stays_selected(spark):
    tick = spark.createDataFrame([(f"S{i}_THB", float(10 - i)) for i in range(4)], "symbol string, volume_thb_24h double")
    listing = spark.createDataFrame([], "symbol string, name string, listed_at timestamp_ntz")
    state = spark.createDataFrame([("S3_THB",)], "symbol string")
    none = LakeTables(spark, shared_dir(spark)).empty("pairs")
    got = {r["symbol"]: (r["rank_24h"], r["selected"]) for r in ingest.refresh_pairs(none, tick, listing, state, F.lit(T0).cast("timestamp_ntz"), Settings(top_n=2)).collect()}
    assert got == {"S0_THB": (1, True), "S1_THB": (2, True), "S2_THB": (None, False), "S3_THB": (None, True)}


def test_event_filter_edges(spark, lake):
    rows = [("a", minute(0), 10.0, 10.0, None), ("b", minute(0), 10.0, 10.0, 1), ("c", minute(0), 10.0, 10.0, 2), ("d", minute(-60 * 24 * 200), 50.0, 50.0, 0)]
    df = spark.createDataFrame(rows, "event_id string, start_ts timestamp_ntz, pump_pct double, max_vol_x double, concurrent_symbols int")
    ids = lambda **k: sorted(r["event_id"] for r in serving.EventFilter(minute(10), **k).apply(df).collect())
    assert ids() == ["a", "b"] and ids(days=0) == ["a", "b", "d"] and ids(single=False) == ["a", "b", "c"]


def test_late_copies_of_one_symbol_per_batch(spark, lake):
    """The newer copy lands first; a batch of one symbol leaves the others alone; a repeated batch changes nothing."""
    action = jobs.latest_candles(lake)
    newer = bars(spark, [(0, 9)]).withColumn("ingested_at", F.lit(minute(5)))
    batches = [newer, bars(spark, [(90_000, 4)], "B"), bars(spark, [(0, 1), (1, 2), (600, 3)])]
    for n, rows in enumerate([*batches, batches[2]]):
        action(rows, min(n, 2))
    got = {(r["symbol"], r["ts"]): r["close"] for r in action.current().collect()}
    assert got == {("A", minute(0)): 9.0, ("A", minute(1)): 2.0, ("A", minute(600)): 3.0, ("B", minute(90_000)): 4.0}


def test_triggers_over_batches_in_any_order(spark, lake):
    """Across midnight and backwards: a late signal opens its own trigger and takes back one that follows too soon."""
    action = jobs.refractory_triggers(lake)
    features = lambda ms: spark.createDataFrame([("A", minute(m), 0.05, 4.0) for m in ms], "symbol string, ts timestamp_ntz, chg_5m double, vol_x_5m double")
    for n, part in enumerate(([1450, 1500], [100, 131], [1430], [45, 80], [0, 20])):
        action(features(part), n)
    assert sorted(r["ts"] for r in action.current().collect()) == [minute(m) for m in (0, 80, 131, 1430, 1500)]


def test_history_and_empty_slices(spark, lake):
    rows = lake.empty("forecasts")
    cells = {"model_name": "'m'", "symbol": "'A'", "predicted": "1.0"}
    one = spark.range(1).select(*[F.expr(cells.get(c, f"CAST(NULL AS {t})")).cast(t).alias(c) for c, t in rows.dtypes])
    two = one.withColumn("model_name", F.lit("k"))
    for model, some in (("m", one), ("m", one), ("k", two), ("m", one.where("false"))):
        runs.republish(lake, model, some)
    assert [r["model_name"] for r in lake.read("forecasts").collect()] == ["k"]
    assert sorted(r["model_name"] for r in lake.read("forecast_history").collect()) == ["k", "m"]


def test_whole_pipeline_and_training_runs(spark, lake):
    """Bronze to silver to gold to models on the smallest data set, through stored tables."""
    lake.append("bronze_candles", B.b1(spark, SF.replace("0.001", "0.01")))
    lakehouse.refresh_silver(lake)
    counts = lakehouse.refresh_gold(lake)
    assert counts["events"] == lake.read("events").count() > 30
    assert lake.read("dq_symbol").count() == 5 and lake.read("gold_refresh_log").count() == 1
    fast = Settings(regress_rounds=3, warn_rounds=3, direction_rounds=2, forest_trees=20, min_direction_rows=50)
    store = registry.ModelStore(lake)
    assert runs.volume(lake, store, "r1", B.AS_OF, fast) in (True, False)
    assert runs.volatility(lake, store, "r1", B.AS_OF, fast) in (True, False)
    assert runs.early_warning(lake, store, "r1", B.AS_OF, fast) in (True, False)
    assert runs.direction_experiment(lake, store, "r1", fast) is False
    assert runs.anomaly_scoring(lake, fast) == counts["events"]
    scores = lake.read("events")
    assert scores.where("anomaly_score IS NULL").count() == 0
    lakehouse.refresh_gold(lake)
    assert lake.read("events").where("anomaly_score IS NULL").count() == 0
    log = {r["model_name"]: r for r in lake.read("model_metrics").collect()}
    assert set(log) == {"volume_forecast", "volatility_forecast", "early_warning", "direction_experiment", "anomaly_scoring"}
    for name, rows in (("volume_forecast", 6), ("volatility_forecast", 30)):
        if log[name]["deployed"]:
            assert lake.read("forecasts").where(F.col("model_name") == name).count() == rows
    assert lake.read("forecast_backtest").select("model_name").distinct().count() == 2
    assert candles.data_quality(lake.read("bronze_candles")).count() == 5
