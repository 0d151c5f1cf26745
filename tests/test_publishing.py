"""Publications chained on versions equal a batch publish of each version."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import minute
from tidewick.config import Settings
from tidewick.learning import forecast, registry, runs
from tidewick.schemas import SCHEMAS
from tidewick.session import fresh_path
from tidewick.sources.lake import LakeTables
from tidewick.streaming import publishing

FEW = Settings(regress_rounds=5)


@pytest.fixture()
def lake(spark):
    return LakeTables(spark, fresh_path(spark, "lake"))


def market(spark, n):
    return spark.createDataFrame([(minute(60 * h), 2, 60, 100.0 + 50 * math.sin(h / 4), 1.0) for h in range(n)], SCHEMAS["market_hourly"])


def history(lake):
    return sorted(map(tuple, lake.read("forecast_history").collect()), key=str)


def test_each_version_is_published_once_as_a_batch_would(spark, lake):
    store, mark = registry.ModelStore(lake), fresh_path(spark, "mark")
    model, _ = forecast.train_volume(forecast.volume_frame(market(spark, 300), minute(60 * 300)), FEW)
    lake.replace("market_hourly", market(spark, 200))
    publishing.on_versions(lake, store, mark, FEW).awaitTermination()
    assert history(lake) == []  # no champion yet
    store.deploy("volume_forecast", "r1", model)
    for n in (240, 300):  # both appear before the stream runs again
        lake.replace("market_hourly", market(spark, n))
    publishing.on_versions(lake, store, mark, FEW).awaitTermination()
    got = history(lake)

    batch = LakeTables(spark, fresh_path(spark, "lake"))
    registry.ModelStore(batch).deploy("volume_forecast", "r1", model)
    for n in (240, 300):
        batch.replace("market_hourly", market(spark, n))
        runs.publish_volume(batch, registry.ModelStore(batch), minute(60 * n), FEW)
    assert got == history(batch) and {r[4] for r in got} == {minute(60 * 240), minute(60 * 300)}
    current = sorted(map(tuple, lake.read("forecasts").collect()), key=str)
    assert current == sorted(map(tuple, batch.read("forecasts").collect()), key=str)

    publishing.on_versions(lake, store, mark, FEW).awaitTermination()
    assert history(lake) == got  # a restart publishes nothing twice
    publishing.on_versions(lake, store, fresh_path(spark, "mark"), FEW).awaitTermination()
    assert {r for r in history(lake) if r[4] >= minute(60 * 240)} == set(got)  # nor does a lost checkpoint


def test_empty_version_publishes_nothing(spark, lake):
    store = registry.ModelStore(lake)
    lake.replace("market_hourly", lake.empty("market_hourly"))
    publishing.on_versions(lake, store, fresh_path(spark, "mark"), FEW).awaitTermination()
    assert history(lake) == []
