"""Order statistics, ranks, scores and correlations that never gather a group in one task.

Values are counted first; the counts are then scanned in value blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.config import DEFAULTS, Settings
from tidewick.functions.numeric import pearson, ratio
from tidewick.functions.timefn import DAY, floor_div, micros
from tidewick.operators.blocks import running_total


def value_block(value: Column) -> Column:
    """A block number that never decreases with the value; about 1.5 % wide."""
    size = F.floor(F.ln(F.abs(value) * 1024 + 1) * 64)
    return F.when(value < 0, -size).otherwise(size).cast("long")


def _counted(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return running_total(counts, keys, value, "_n", "_upto", value_block(F.col(value)))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles per key, one column per entry of ``probs``, plus n."""
    counted = _counted(df, keys, value)
    sizes = counted.groupBy(*keys).agg(F.max("_upto").alias("n"))
    ranked = counted.join(sizes, keys) if keys else counted.withColumn("n", sizes.select("n").scalar())
    pos = {name: F.lit(p) * (F.col("n") - 1) for name, p in probs.items()}
    picks = []
    for name, at in pos.items():
        picks.append(F.min(F.when(F.col("_upto") > F.floor(at), F.col(value))).alias(f"_{name}_lo"))
        picks.append(F.min(F.when(F.col("_upto") > F.ceil(at), F.col(value))).alias(f"_{name}_hi"))
    found = ranked.groupBy(*keys, "n").agg(*picks)
    return found.select(*keys, "n", *[
        (F.col(f"_{name}_lo") + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * (at - F.floor(at))).alias(name)
        for name, at in pos.items()
    ])


def impute_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULL by the median of its column; medians come as one one-row lookup."""
    melted = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])).alias("m")).select("m.*")
    medians = exact_quantiles(melted, ["name"], "value", {"median": 0.5})
    lookup = medians.agg(F.map_from_entries(F.collect_list(F.struct("name", "median")))).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.element_at(lookup, F.lit(c))) for c in columns})


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank in (0, 1]; equal values share the mean of their positions. NULL stays NULL."""
    counted = _counted(df, [], value)
    total = counted.agg(F.max("_upto")).scalar()
    place = (F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / F.lit(2.0)) / total
    return df.join(counted.select(value, place.alias(out)), value, "left")


def roc_auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL with a single class."""
    by_score = scored.groupBy(score).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.sum(1 - F.col(label).cast("long")).alias("_neg"))
    ranked = running_total(by_score, [], score, "_neg", "_below", value_block(F.col(score)))
    won = F.sum(F.col("_pos") * (F.col("_below") - F.col("_neg") / F.lit(2.0)))
    return ranked.agg(ratio(won, (F.sum("_pos") * F.sum("_neg")).cast("double")).alias("auc"))


def precision_recall(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision and recall of a 0/1 prediction, 0 where undefined."""
    hit = F.sum((F.col(label) * F.col(predicted)).cast("double"))
    return scored.agg(
        F.coalesce(ratio(hit, F.sum(F.col(predicted).cast("double"))), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(hit, F.sum(F.col(label).cast("double"))), F.lit(0.0)).alias("recall"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )


def split_cut(df: DataFrame, time_col: str, test_share: float = DEFAULTS.test_share) -> DataFrame:
    """One row ``cut``: the time at position int(n * (1 - share)) of the sorted times."""
    counts = df.groupBy(time_col).agg(F.count("*").alias("_n")).withColumn("_us", micros(time_col))
    ranked = running_total(counts, [], "_us", "_n", "_upto", floor_div(F.col("_us"), DAY))
    at = F.floor(df.agg(F.count("*")).scalar() * F.lit(1.0 - test_share))
    return ranked.agg(F.min(F.when(F.col("_upto") > at, F.col(time_col))).alias("cut"))


def time_split(df: DataFrame, time_col: str, test_share: float = DEFAULTS.test_share) -> DataFrame:
    """Add ``is_test``: rows at or after the cut."""
    return df.withColumn("is_test", F.col(time_col) >= split_cut(df, time_col, test_share).scalar())


def regression_scores(rows: DataFrame) -> DataFrame:
    """MAPE and RMSE of ``predicted`` and ``baseline`` against ``actual``.

    A zero actual has no percentage error: those rows are counted, not averaged.
    """
    def mape(col: str) -> Column:
        return F.avg(F.abs(F.col(col) - F.col("actual")) / F.nullif(F.col("actual"), F.lit(0.0))) * 100

    def rmse(col: str) -> Column:
        return F.sqrt(F.avg(F.pow(F.col(col) - F.col("actual"), F.lit(2.0))))

    return rows.agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("actual") == 0, 1)).alias("zero_actuals"),
        mape("predicted").alias("mape"), rmse("predicted").alias("rmse"),
        mape("baseline").alias("baseline_mape"), rmse("baseline").alias("baseline_rmse"),
    )


def direction_scores(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Accuracy, majority baseline and fee-adjusted mean return of predicted rises.

    ``rows``: is_test, up, pred (0/1) and fwd_ret.
    """
    test, up = F.col("is_test"), F.col("up")
    majority = F.when(F.avg(F.when(~test, up)) >= 0.5, 1).otherwise(0)
    rise_share = F.avg(F.when(test, up.cast("double")))
    gross = F.coalesce(F.avg(F.when(test & (F.col("pred") == 1), F.col("fwd_ret"))) * 100, F.lit(0.0))
    return rows.agg(
        F.count(F.when(~test, 1)).alias("train_rows"), F.count(F.when(test, 1)).alias("test_rows"),
        (F.avg(F.when(test, (F.col("pred") == up).cast("double"))) * 100).alias("accuracy"),
        (F.when(majority == 1, rise_share).otherwise(1 - rise_share) * 100).alias("baseline"),
        F.count(F.when(test & (F.col("pred") == 1), 1)).alias("trades"),
        gross.alias("gross_pct"), (gross - settings.fee_round_trip_pct).alias("net_pct"),
    )


def hourly_returns(hourly: DataFrame) -> DataFrame:
    """Log return to the previous present hour. At most one row per symbol and hour."""
    w = Window.partitionBy("symbol").orderBy("hour_utc")
    prior = F.nullif(F.lag("close").over(w), F.lit(0.0))
    return hourly.where("close > 0").select("symbol", "hour_utc", F.ln(F.col("close") / prior).alias("r"))


def correlation_matrix(returns: DataFrame, symbols: DataFrame) -> DataFrame:
    """Upper triangle (with diagonal) over the listed symbols, a top-N set of at most 30.

    Both sides shrink to the list before the join and pairs are summed where they arise.
    """
    kept = returns.where("r IS NOT NULL").join(symbols.select("symbol"), "symbol", "left_semi")
    left = kept.select("hour_utc", F.col("symbol").alias("a"), F.col("r").alias("ra"))
    right = kept.select("hour_utc", F.col("symbol").alias("b"), F.col("r").alias("rb"))
    return left.join(right, "hour_utc").where("a <= b").groupBy("a", "b").agg(
        pearson("ra", "rb").alias("c"), F.count("*").alias("n"))


def benchmark_correlation(returns: DataFrame, benchmark: str, min_hours: int = 24) -> DataFrame:
    """Each other symbol against one benchmark; pairs with too few hours are left out."""
    known = returns.where("r IS NOT NULL")
    base = known.where(F.col("symbol") == benchmark).select("hour_utc", F.col("r").alias("rb"))
    return known.where(F.col("symbol") != benchmark).join(base, "hour_utc").groupBy("symbol").agg(
        pearson("r", "rb").alias("c"), F.count("*").alias("n")).where(F.col("n") >= min_hours)
