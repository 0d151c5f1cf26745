"""Early warning: does a first signal become a full pump within the hour?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidewick.config import DEFAULTS, OUTCOME_NO_PUMP, OUTCOME_PUMP, OUTCOME_TRACKING, Settings
from tidewick.functions.numeric import change
from tidewick.functions.timefn import MINUTE, micros, shift
from tidewick.learning import boosting
from tidewick.operators import stats
from tidewick.operators.events import refractory_triggers
from tidewick.operators.grid import with_clock
from tidewick.plans.serving import at

# The model inputs.
INPUTS = [
    "chg_5m", "vol_x_5m", "ret_1m", "range_1m", "active_share_1d", "log_vol5", "gap_min", "hour_sin", "hour_cos", "dow",
]
QUIET_MIN = 30
MATURE_MIN = 60
RECENT_HOURS = 48


def qualifying(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return silver.where((F.col("chg_5m") >= settings.early_chg) & (F.col("vol_x_5m") >= settings.early_vol_x)).select(
        "symbol", "ts", "chg_5m", "vol_x_5m", "ret_1m", "range_1m", "active_share_1d", "gap_min",
        F.ln(1 + F.col("vol5_thb")).alias("log_vol5"),
        change(F.col("max_high_next60"), F.col("open_5m")).alias("future_gain"))


def triggers(silver: DataFrame, since: Column | None = None, full_history: bool = False, settings: Settings = DEFAULTS) -> DataFrame:
    """First signals after a quiet half hour.

    ``since`` limits the rows before the quiet test, so the first row past it always
    triggers; ``full_history`` tests on all rows and limits afterwards.
    """
    rows = qualifying(silver, settings)
    recent = F.col("ts") >= since if since is not None else F.lit(True)
    if full_history:
        return refractory_triggers(rows, QUIET_MIN, settings).where(recent)
    return refractory_triggers(rows.where(recent), QUIET_MIN, settings)


def with_inputs(rows: DataFrame) -> DataFrame:
    return with_clock(rows.withColumn("gap_min", F.least(F.coalesce("gap_min", F.lit(60)), F.lit(1440))), "ts")


def labelled(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    known = rows.where(F.col("future_gain").isNotNull())
    return with_inputs(known).withColumn("label", (F.col("future_gain") >= settings.target_pump).cast("int"))


def gate(split: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row saying whether there is enough to train and to test on."""
    return split.agg(
        F.count("*").alias("rows"), F.sum("label").alias("positives"),
        F.count_distinct(F.when(F.col("is_test"), F.col("label"))).alias("test_classes"),
    ).withColumn("ok", (F.col("rows") >= settings.min_triggers) & (F.col("positives") >= settings.min_positives) & (F.col("test_classes") == 2))


def balanced(train: DataFrame) -> DataFrame:
    """Weight n / (2 * n_class), so both classes weigh the same in total."""
    n, pos = train.agg(F.count("*")).scalar(), train.agg(F.sum("label")).scalar()
    return train.withColumn("weight", n / (2.0 * F.when(F.col("label") == 1, pos).otherwise(n - pos)))


def train(split: DataFrame, settings: Settings = DEFAULTS, rounds: int | None = None) -> boosting.Forest:
    """Missing inputs stay missing: the trees learn where they go."""
    rows = balanced(split.where("NOT is_test"))
    return boosting.train(rows, INPUTS, "label", rounds or settings.warn_rounds, settings.learning_rate, logistic=True, weight="weight")


def score(model: boosting.Forest, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def evaluation(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """AUC of the model and of volume alone, precision and recall of model and rule; one row."""
    ranks = scored.select("label", "vol_x_5m", "prob", (F.col("prob") >= 0.5).cast("int").alias("pred"),
                          (F.col("vol_x_5m") >= settings.rule_vol_x).cast("int").alias("rule"))
    own, rule = stats.precision_recall(ranks, "label", "pred"), stats.precision_recall(ranks, "label", "rule")
    parts = scored.sparkSession.range(1).select(
        stats.roc_auc(ranks, "label", "prob").scalar().alias("auc"),
        stats.roc_auc(ranks, "label", "vol_x_5m").scalar().alias("baseline_auc"),
        own.select(F.struct("*")).scalar().alias("_own"), rule.select(F.struct("*")).scalar().alias("_rule"))
    return parts.select("auc", "baseline_auc", "_own.precision", "_own.recall", "_own.positive_rate",
                        F.col("_rule.precision").alias("rule_precision"), F.col("_rule.recall").alias("rule_recall"))


def outcome(ts: Column, newest: Column, gain: Column, settings: Settings = DEFAULTS) -> Column:
    """An hour must have passed; a missing gain then counts as no pump."""
    done = micros(newest) - micros(ts) >= MATURE_MIN * MINUTE
    return F.when(~done, F.lit(OUTCOME_TRACKING)).when(gain >= settings.target_pump, F.lit(OUTCOME_PUMP)).otherwise(F.lit(OUTCOME_NO_PUMP))


def recent_warnings(silver: DataFrame, model: boosting.Forest, as_of: dt.datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows for ``early_warnings``: triggers of the last two days, scored by the champion."""
    newest = silver.agg(F.max("ts")).scalar()
    rows = with_inputs(triggers(silver, since=shift(newest, hours=-RECENT_HOURS), settings=settings))
    return score(model, rows).select(
        "symbol", "ts", F.col("prob").alias("probability"), (F.col("chg_5m") * 100).alias("chg_5m_pct"), "vol_x_5m",
        outcome(F.col("ts"), newest, F.col("future_gain"), settings).alias("outcome"), at(as_of).alias("generated_at"))
