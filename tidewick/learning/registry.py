"""Champion-challenger decisions over the metrics log, and stored models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.learning import boosting
from tidewick.sources.lake import LakeTables


def beats_baseline(value: Column, baseline: Column, higher: Column) -> Column:
    """Strictly better than the baseline, or there is none."""
    return baseline.isNull() | F.when(higher, value > baseline).otherwise(value < baseline)


def not_worse(value: Column, champion: Column, higher: Column) -> Column:
    """The champion is not strictly better; a tie goes to the challenger."""
    return champion.isNull() | F.when(higher, value >= champion).otherwise(value <= champion)


def replay(trials: DataFrame) -> DataFrame:
    """Decide a whole history of trials in time order.

    A deployment never worsens the champion, so the champion before a trial is the best
    earlier value that beat its own baseline and came with a model.
    """
    value, higher = F.col("value"), F.col("higher_is_better")
    eligible = F.col("has_model") & beats_baseline(value, F.col("baseline"), higher)
    before = Window.partitionBy("model_name", "metric").orderBy("run_at").rowsBetween(Window.unboundedPreceding, -1)
    best = F.when(F.col("_ok"), value)
    champion = F.when(higher, F.max(best).over(before)).otherwise(F.min(best).over(before))
    return trials.withColumn("_ok", eligible).withColumn("champion", champion).withColumn(
        "deployed", F.col("_ok") & not_worse(value, F.col("champion"), higher)).drop("_ok")


def decide(metrics: DataFrame, challenger: DataFrame) -> DataFrame:
    """``challenger``: one row of model_name, metric, value, baseline, higher_is_better,
    has_model. Adds ``champion`` (last deployed value of that model and metric) and
    ``deployed``."""
    last = metrics.where("deployed").groupBy("model_name", "metric").agg(F.max_by("value", "run_at").alias("champion"))
    value, higher = F.col("value"), F.col("higher_is_better")
    gate = F.col("has_model") & beats_baseline(value, F.col("baseline"), higher) & not_worse(value, F.col("champion"), higher)
    return challenger.join(last, ["model_name", "metric"], "left").withColumn("deployed", gate)


class ModelStore:
    """Trained forests in the lake; the newest pointer row of a name is the deployed one."""

    def __init__(self, lake: LakeTables):
        self.lake = lake

    def _pointer(self, name: str) -> str:
        return f"{self.lake.root}/models/{name}_current"

    def deploy(self, name: str, run_id: str, model: boosting.Forest, side: dict[str, DataFrame] | None = None) -> None:
        path = f"{self.lake.root}/models/{name}/{run_id}"
        model.save(self.lake.spark, f"{path}/forest")
        for key, frame in (side or {}).items():
            frame.write.mode("overwrite").parquet(f"{path}/{key}")
        spark = self.lake.spark
        spark.range(1).select(F.lit(path).alias("path"), F.current_timestamp().alias("deployed_at")).coalesce(1).write.mode(
            "append").parquet(self._pointer(name))

    def _path(self, name: str) -> str | None:
        if not self.lake.exists(self._pointer(name)):
            return None
        return self.lake.spark.read.parquet(self._pointer(name)).agg(F.max_by("path", "deployed_at")).first()[0]

    def load(self, name: str) -> boosting.Forest | None:
        path = self._path(name)
        return boosting.load(self.lake.spark, f"{path}/forest") if path else None

    def side_table(self, name: str, key: str) -> DataFrame | None:
        path = self._path(name)
        return self.lake.spark.read.parquet(f"{path}/{key}") if path else None


def log_trial(lake: LakeTables, decided: DataFrame, train_rows: int, test_rows: int, extra: Column) -> None:
    """Append the decision to the metrics log, deployed or not."""
    lake.append("model_metrics", decided.select(
        "model_name", "metric", "value", "baseline", "higher_is_better", "deployed",
        F.lit(train_rows).cast("bigint").alias("train_rows"), F.lit(test_rows).cast("bigint").alias("test_rows"),
        extra.alias("extra"), F.current_timestamp().cast("timestamp_ntz").alias("run_at")))
