"""Experiment: will the price be higher in 15 minutes? Measured after fees, never deployed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewick.config import DEFAULTS, Settings
from tidewick.functions.numeric import change
from tidewick.learning import boosting
from tidewick.operators import stats
from tidewick.operators.grid import with_clock
from tidewick.operators.sampling import hash_sample

# The model inputs.
INPUTS = ["ret_1m", "chg_5m", "vol_x_5m", "range_1m", "active_share_1d", "hour_sin", "hour_cos", "dow"]


def directions(silver: DataFrame) -> DataFrame:
    """Minutes with a price 14 to 15 minutes later that differs from now; ties are left out."""
    later, now = F.col("close_next15"), F.col("close")
    return silver.where(later.isNotNull() & (later != now) & F.col("vol_x_5m").isNotNull()).select(
        "symbol", "ts", "ret_1m", "chg_5m", "vol_x_5m", "range_1m", "active_share_1d",
        change(later, now).alias("fwd_ret"), (later > now).cast("int").alias("up"))


def sampled(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return hash_sample(rows, [F.col("symbol"), F.col("ts")], settings.direction_sample, settings.seed)


def enough_rows(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return rows.agg(F.count("*").alias("rows")).withColumn("ok", F.col("rows") >= settings.min_direction_rows)


def train(split: DataFrame, settings: Settings = DEFAULTS, rounds: int | None = None) -> boosting.Forest:
    rows = _ready(split.where("NOT is_test"))
    return boosting.train(rows, INPUTS, "up", rounds or settings.direction_rounds, settings.learning_rate, logistic=True)


def _ready(rows: DataFrame) -> DataFrame:
    return with_clock(rows, "ts")


def run(silver: DataFrame, top: DataFrame, settings: Settings = DEFAULTS, rounds: int | None = None) -> DataFrame:
    """One row of scores for the top symbols."""
    rows = sampled(directions(silver.join(top, "symbol", "left_semi")), settings)
    split = stats.time_split(rows, "ts", settings.test_share)
    model = train(split, settings, rounds)
    judged = model.transform(_ready(split)).withColumn("pred", F.col("prediction").cast("int"))
    return stats.direction_scores(judged, settings)


def gated(silver: DataFrame, top: DataFrame, settings: Settings = DEFAULTS, rounds: int | None = None) -> DataFrame:
    """``run``, or no row where there are fewer rows than ``min_direction_rows``."""
    rows = sampled(directions(silver.join(top, "symbol", "left_semi")), settings)
    if enough_rows(rows, settings).first()["ok"]:
        return run(silver, top, settings, rounds)
    return silver.sparkSession.createDataFrame([], "train_rows long, test_rows long, accuracy double, baseline double, trades long, gross_pct double, net_pct double")
