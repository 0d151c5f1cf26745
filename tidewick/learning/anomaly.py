"""Isolation forest over event features: trees grown in parallel, rows scored in batches.

A tree sees at most ``forest_sample`` rows and the whole forest has at most
trees * 2 * sample nodes whatever the number of events, which bounds what is broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewick.config import DEFAULTS, Settings
from tidewick.operators import stats

# The model inputs.
INPUTS = ["pump_pct", "max_vol_x", "max_chg_5m_pct", "signal_minutes", "active_share_1d", "log_vol", "minutes_to_peak"]
NODE = "tree int, node int, feature int, cut double, left int, right int, depth double"
EULER = 0.5772156649015329
HASH_SPAN = 1 << 31


def event_inputs(events: DataFrame) -> DataFrame:
    """The model's columns, logs of the two wide-ranging ones, medians for missing values."""
    raw = events.select(
        "event_id", "pump_pct", F.log1p("max_vol_x").alias("max_vol_x"), "max_chg_5m_pct",
        F.col("signal_minutes").cast("double").alias("signal_minutes"), "active_share_1d",
        F.log1p("vol_thb_event").alias("log_vol"), "minutes_to_peak")
    return stats.impute_medians(raw, INPUTS)


def expected_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    deep = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, deep, np.where(n == 2, 1.0, 0.0))


def _subsamples(rows: DataFrame, settings: Settings) -> DataFrame:
    """Each tree's rows, chosen by hash. A row meets all trees in one expression and only its
    hits are exploded; a slight surplus is drawn and trimmed to the exact size per tree."""
    size = settings.forest_sample
    surplus = size + 8 * size ** 0.5
    odds = rows.agg(F.least(F.lit(1.0), F.lit(surplus) / F.count("*")) * HASH_SPAN).scalar()
    draw = lambda t: F.pmod(F.xxhash64("event_id", t, F.lit(settings.seed)), F.lit(HASH_SPAN))
    trees = F.sequence(F.lit(0), F.lit(settings.forest_trees - 1))
    hits = F.filter(F.transform(trees, lambda t: F.struct(t.alias("tree"), draw(t).alias("draw"))), lambda s: s["draw"] < F.col("_odds"))
    return rows.withColumn("_odds", odds).select("event_id", *INPUTS, F.inline(hits))


def _grow(settings: Settings):
    size, seed = settings.forest_sample, settings.seed
    limit = int(np.ceil(np.log2(max(size, 2))))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["draw", "event_id"]).head(size)
        tree, data = int(rows["tree"].iloc[0]), rows[INPUTS].to_numpy(float)
        rng = np.random.default_rng([seed, tree])
        nodes: list[list] = []
        todo = [(np.arange(len(data)), 0, -1, 0)]
        while todo:
            members, depth, parent, side = todo.pop()
            here = len(nodes)
            if parent >= 0:
                nodes[parent][side] = here
            low, high = data[members].min(axis=0), data[members].max(axis=0)
            varied = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or len(varied) == 0:
                nodes.append([tree, here, -1, 0.0, -1, -1, depth + float(expected_depth(len(members)))])
                continue
            feature = int(rng.choice(varied))
            cut = float(rng.uniform(low[feature], high[feature]))
            nodes.append([tree, here, feature, cut, -1, -1, 0.0])
            goes_left = data[members, feature] <= cut
            todo.append((members[~goes_left], depth + 1, here, 5))
            todo.append((members[goes_left], depth + 1, here, 4))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "depth"])

    return grow


def grow_forest(inputs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Nodes of all trees, one task per group of trees."""
    return _subsamples(inputs, settings).groupBy("tree").applyInPandas(_grow(settings), NODE)


def raw_scores(inputs: DataFrame, forest: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``raw`` in (0, 1): the shorter the mean path to isolation, the higher."""
    nodes = forest.toPandas()  # at most trees * 2 * sample rows
    sample = min(settings.forest_sample, inputs.count())
    trees = [g.sort_values("node") for _, g in nodes.groupby("tree")]
    packed = [tuple(g[c].to_numpy() for c in ("feature", "cut", "left", "right", "depth")) for g in trees]
    shared = inputs.sparkSession.sparkContext.broadcast(packed)
    norm = float(expected_depth(sample)) or 1.0

    @F.pandas_udf("double")
    def isolation(features: pd.Series) -> pd.Series:
        x = np.vstack(features.to_numpy()) if len(features) else np.empty((0, len(INPUTS)))
        row = np.arange(len(x))
        total = np.zeros(len(x))
        for feature, cut, left, right, depth in shared.value:
            at = np.zeros(len(x), dtype=int)
            while (inner := feature[at] >= 0).any():
                split = np.maximum(feature[at], 0)
                step = np.where(x[row, split] <= cut[at], left[at], right[at])
                at = np.where(inner, step, at)
            total += depth[at]
        return pd.Series(2.0 ** (-total / (len(shared.value) * norm)))

    return inputs.withColumn("raw", isolation(F.array(*[F.col(c).cast("double") for c in INPUTS])))


def enough_events(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return events.agg(F.count("*").alias("events")).withColumn("ok", F.col("events") >= settings.min_anomaly_events)


def anomaly_scores(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """event_id and anomaly_score: the percentile rank of the raw score."""
    inputs = event_inputs(events)
    raw = raw_scores(inputs, grow_forest(inputs, settings), settings).select("event_id", "raw")
    return stats.average_rank(raw, "raw", "anomaly_score").select("event_id", "anomaly_score")
