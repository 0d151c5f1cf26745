"""The histogram booster against brute force, its arrays in Spark, and the models that use it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import minute
from tests.test_learning import hours
from tidewick.config import Settings
from tidewick.learning import boosting, direction, forecast, warning
from tidewick.operators import grid, stats


def predicted(forest, x):
    """Row by row, as the docstring of a forest says. ``x``: rows of inputs, NaN for missing."""
    out = []
    for row in x:
        total = forest.base
        for t in range(len(forest.feature)):
            k = 0
            for _ in range(forest.depth):
                v = row[forest.feature[t, k]]
                right = forest.missing_right[t, k] if np.isnan(v) else v > forest.cut[t, k]
                k = 2 * k + 1 + int(right)
            total += forest.value[t, k - (2**forest.depth - 1)]
        out.append(total)
    return np.array(out)


def made(n, seed=0, classes=False):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 1, (n, 3)), 2)
    x[rng.random(n) < 0.2, 1] = np.nan
    y = np.where(np.isnan(x[:, 1]), 2.0, 0.0) + (x[:, 0] > 0.3) * 1.5 + rng.normal(0, 0.1, n)
    return x, (y > 1.2).astype(float) if classes else y


def frame(spark, x, y, weight=None):
    rows = [(*[None if np.isnan(v) and k % 2 else float(v) for v in r], float(t), float(weight[k]) if weight is not None else 1.0) for k, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, w double")


def slow_best(x, g, h, cuts):
    """Every cut of every input, missing values on both sides."""
    best, worth = None, lambda m: g[m].sum() ** 2 / max(h[m].sum(), 1e-300)
    everything = np.ones(len(x), bool)
    for f in range(x.shape[1]):
        gone = np.isnan(x[:, f])
        for c in [*cuts[f], np.inf]:
            for right_if_gone in (False, True):
                left = np.where(gone, not right_if_gone, x[:, f] <= c)
                if min(left.sum(), (~left).sum()) >= boosting.LEAST_ROWS and min(h[left].sum(), h[~left].sum()) >= boosting.LEAST_CURVATURE:
                    gain = worth(left) + worth(~left) - worth(everything)
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, left)
    return best


@pytest.mark.parametrize("logistic, block", [(False, 90), (True, 90), (False, 1000), (True, 1000)])
def test_trees_equal_a_search_over_all_splits(spark, monkeypatch, logistic, block):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block)  # five blocks, or one
    monkeypatch.setattr(boosting, "CUT", 2)
    x, y = made(400, classes=logistic)
    weight = np.where(y > y.mean(), 1.5, 0.75) if logistic else np.ones(400)
    rows = frame(spark, x, y, weight)
    forest = boosting.train(rows, ["a", "b", "c"], "y", 5, 0.3, logistic=logistic, weight="w", depth=3)
    cuts = boosting.cuts_of(rows, ["a", "b", "c"])
    mean = (y * weight).sum() / weight.sum()
    score = np.full(400, np.log(mean / (1 - mean)) if logistic else mean)
    for _ in range(5):
        p = 1 / (1 + np.exp(-score))
        g, h = (weight * (p - y), weight * p * (1 - p)) if logistic else (weight * (score - y), weight)

        def grow(m, level):
            found = slow_best(x[m], g[m], h[m], cuts) if level < 3 else None
            if found is None:
                score[m] -= 0.3 * g[m].sum() / h[m].sum()
                return
            at = np.flatnonzero(m)
            for side in (found[1], ~found[1]):
                own = np.zeros(400, bool)
                own[at[side]] = True
                grow(own, level + 1)

        grow(np.ones(400, bool), 0)
    assert np.allclose(predicted(forest, x), score, atol=1e-8)


def test_arrays_in_spark_and_stored_forest(spark, tmp_path):
    x, y = made(600, 1, classes=True)
    rows = frame(spark, x, y).withColumn("k", F.monotonically_increasing_id())
    forest = boosting.train(rows, ["a", "b", "c"], "y", 30, 0.1, logistic=True)
    forest.save(spark, str(tmp_path / "f"))
    again = boosting.load(spark, str(tmp_path / "f"))
    got = again.transform(rows).orderBy("k").collect()
    at = np.array([[np.nan if r[c] is None else r[c] for c in "abc"] for r in got])
    want = 1 / (1 + np.exp(-predicted(forest, at)))
    assert np.allclose([r["prob"] for r in got], want, atol=1e-12) and [r["prediction"] for r in got] == (want > 0.5).astype(float).tolist()
    assert np.mean((want > 0.5) == np.array([r["y"] for r in got])) > 0.95
    plan = again.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_missing_values_learn_their_side_and_odd_tables(spark):
    x, y = made(300, 2)
    forest = boosting.train(frame(spark, x, y), ["a", "b", "c"], "y", 60, 0.2)
    low, high = predicted(forest, np.array([[0.0, 0.0, 0.0], [0.0, np.nan, 0.0]]))
    assert high - low > 1.5
    none = boosting.train(frame(spark, x, y).where("false"), ["a"], "y", 5, 0.1)
    assert none.transform(frame(spark, x, y)).select("prediction").distinct().collect() == [(0.0,)]
    few = boosting.train(frame(spark, x[:10], y[:10]), ["a", "b"], "y", 3, 0.1)
    assert np.allclose(predicted(few, x[:5]), y[:10].mean())
    gone = frame(spark, x, y).withColumn("y", F.when(F.col("c") > 0, F.col("y"))).withColumn("b", F.lit(None).cast("double"))
    assert len(boosting.train(gone, ["a", "b"], "y", 2, 0.1).feature) == 2


def test_recursive_paths_equal_step_by_step(spark):
    frame_ = grid.with_clock(grid.lagged(grid.densify(hours(spark, 24 * 12), ["y"], None), 12))
    model, _ = forecast.train_volume(frame_, Settings(regress_rounds=20))
    row = forecast.forecast_paths(forecast.last_origins(frame_), model, 6).first()
    past = [r["y"] for r in frame_.orderBy("hour_utc").collect()][-24:]
    clock = {r["hour_utc"]: r for r in frame_.collect()}
    want = []
    for h in range(1, 7):
        day_ago = clock[minute(60 * (24 * 12 - 1 + h - 24))]  # the clock repeats after a day but for the weekday
        dow = (day_ago["dow"] + 1) % 7 if day_ago["dow"] is not None else None
        values = {"lag1": past[-1], "lag2": past[-2], "lag3": past[-3], "lag24": past[-24], "roll24": sum(past) / 24,
                  "hour_sin": day_ago["hour_sin"], "hour_cos": day_ago["hour_cos"], "dow": dow}
        want.append(predicted(model, np.array([[float(values[c]) for c in model.inputs]]))[0])
        past = past[1:] + want[-1:]
    assert np.allclose(row["path"], want, atol=1e-9)


def test_classifier_beats_its_best_single_input_and_gates(spark):
    x, y = made(1500, 3, classes=True)
    rows = frame(spark, x, y).withColumn("is_test", F.pmod(F.xxhash64("a", "c"), F.lit(5)) == 0)
    forest = boosting.train(rows.where("NOT is_test"), ["a", "b", "c"], "y", 80, 0.1, logistic=True)
    tested = forest.transform(rows.where("is_test")).withColumn("label", F.col("y").cast("int"))
    auc = stats.roc_auc(tested, "label", "prob").first()[0]
    assert auc > 0.95 and auc > stats.roc_auc(tested, "label", "a").first()[0] + 0.05
    silver = spark.createDataFrame([], "symbol string, ts timestamp_ntz, close double, close_next15 double, vol_x_5m double, ret_1m double, chg_5m double, range_1m double, active_share_1d double")
    assert direction.gated(silver, spark.createDataFrame([("A",)], "symbol string")).collect() == []
    assert warning.INPUTS and not hasattr(warning, "filled")
