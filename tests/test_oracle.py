"""Every query with an oracle agrees with it."""

import pytest

import __spark_entry__ as driver
from workload import oracle, queries
from workload.compare import connect, differences

# The text operators are optional and have tests of their own.
ORACLES = oracle.all_oracles()
NO_ORACLE = {"clf_predict", "clf_backcast", "anomaly_detect", "ds_alerts", "ds_predictions"}


@pytest.fixture(scope="module")
def small(sf001):
    return connect(sf001)


@pytest.fixture(scope="module")
def medium(sf01):
    return connect(sf01)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_small(spark, sf001, small, name):
    assert differences(driver.queries()[name](spark, sf001), small, ORACLES[name]) == []


@pytest.mark.parametrize(
    "name",
    [
        "clf_training", "clf_training_blocked", "clf_training_by_station_blocked",
        "clf_inference", "clf_inference_by_station", "fact_hourly", "fact_by_station",
        "stg_weather_as_written", "stg_weather_unified", "stg_airquality_as_written",
        "stg_airquality_unified", "anomaly_hourly_band", "ds_heatmap",
    ],
)
def test_medium(spark, sf01, medium, name):
    assert differences(driver.queries()[name](spark, sf01), medium, ORACLES[name]) == []


def test_every_query_has_an_oracle_or_is_a_model_output():
    assert set(queries.all_queries()) - set(ORACLES) == NO_ORACLE
    assert set(ORACLES) <= set(queries.all_queries())


def test_driver_offers_all_of_them():
    assert set(queries.all_queries()) <= set(driver.queries())
    assert ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_model_outputs_run(spark, sf001, name):
    assert driver.queries()[name](spark, sf001).count() >= 0


def test_entry(spark):
    assert driver.entry(spark).count() == 41


def test_known_sizes(spark, sf01):
    """Row counts worked out when the fixtures were designed."""
    expected = {"clf_training": 610, "clf_inference": 1, "stg_weather_as_written": 10001,
                "stg_weather_unified": 720}
    got = {name: driver.queries()[name](spark, sf01).count() for name in expected}
    assert got == expected
