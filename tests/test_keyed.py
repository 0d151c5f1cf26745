"""Merges into keyed tables touch only the buckets of the keys that arrive."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewick.plans import ingest
from tidewick.schemas import SCHEMAS
from tidewick.session import fresh_path, written
from tidewick.sources.keyed import KeyedTable
from tidewick.sources.lake import LakeTables


@pytest.fixture()
def state(spark):
    return KeyedTable(LakeTables(spark, fresh_path(spark, "lake")), "ingest_state", ["symbol"], buckets=8)


def rows(spark, *values):
    return written(spark.createDataFrame([(k, t, n, 1, T0) for k, t, n in values], SCHEMAS["ingest_state"]), "arrivals")


def accumulate(old, new):
    return ingest.upsert(old, new, ["symbol"], replace=["last_ts", "updated_at"], add=["rows_total", "files"])


def held(table):
    return sorted((r["symbol"] or "", r["last_ts"], r["rows_total"], r["files"]) for r in table.read().collect())


def test_unwritten_table_and_no_arrivals(spark, state):
    assert held(state) == [] and state.read().columns == state.lake.empty("ingest_state").columns
    assert state.merge(rows(spark), accumulate) == [] and state.lake.current(state.pointers)[0] == -1


def test_only_touched_buckets_are_read_and_written(spark, state):
    keys = [f"K{i}" for i in range(40)]
    state.merge(rows(spark, *[(k, 1, 10) for k in keys]), accumulate)
    first = state.lake.current(state.pointers)[1]
    seen = []

    def step(old, new):
        seen.extend(old.inputFiles())
        return accumulate(old, new)

    touched = state.merge(rows(spark, ("K3", 5, 2), ("new", 7, 1)), step)
    second = state.lake.current(state.pointers)[1]
    assert 1 <= len(touched) <= 2
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in seen} <= set(touched)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in state.read().inputFiles() if second in f} == set(touched)
    assert all(v == first for b, v in state._manifest(second).items() if b not in touched)
    assert held(state) == sorted([(k, 5 if k == "K3" else 1, 12 if k == "K3" else 10, 2 if k == "K3" else 1) for k in keys] + [("new", 7, 1, 1)])


def test_equals_a_full_rewrite_with_null_keys(spark, state):
    one, two = rows(spark, ("A", 1, 1), ("B", 2, 2)), rows(spark, ("B", 3, 5), ("C", 4, 1))
    state.merge(one, accumulate)
    state.merge(two, accumulate)
    full = accumulate(accumulate(state.lake.empty("ingest_state"), one), two)
    assert held(state) == sorted((r["symbol"], r["last_ts"], r["rows_total"], r["files"]) for r in full.collect())
    state.merge(rows(spark, (None, 9, 1)), accumulate)
    assert held(state)[0] == ("", 9, 1, 1) and len(held(state)) == 4


def test_a_step_may_empty_a_bucket(spark, state):
    state.merge(rows(spark, ("A", 1, 1), ("B", 2, 2)), accumulate)
    state.merge(rows(spark, ("A", 0, 0)), lambda old, new: old.join(new, "symbol", "left_anti"))
    assert held(state) == [("B", 2, 2, 1)]


def test_second_of_two_writers_merges_again(spark, state):
    state.merge(rows(spark, ("A", 1, 1)), accumulate)
    calls = []

    def step(old, new):
        calls.append(old.count())
        if len(calls) == 1:
            state.merge(rows(spark, ("A", 2, 10)), accumulate)
        return accumulate(old, new)

    state.merge(rows(spark, ("A", 3, 100)), step)
    assert len(calls) == 2 and held(state) == [("A", 3, 111, 3)]


def test_pull_advances_only_its_symbols(spark, state):
    state.merge(rows(spark, ("A", 1, 1), ("B", 2, 2)), accumulate)
    pull = spark.createDataFrame([("B", T0), ("B", T0 + dt.timedelta(minutes=1))], "symbol string, ts timestamp_ntz")
    ingest.merge_state(state, pull, F.lit(T0).cast("timestamp_ntz"))
    assert held(state) == [("A", 1, 1, 1), ("B", 1704067260, 4, 2)]


def test_number_of_buckets_stays(spark, state):
    state.merge(rows(spark, ("A", 1, 1)), accumulate)
    with pytest.raises(ValueError, match="8 buckets"):
        KeyedTable(state.lake, "ingest_state", ["symbol"], buckets=4).merge(rows(spark, ("A", 2, 2)), accumulate)
