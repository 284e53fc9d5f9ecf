"""Dashboard tables on hand-made facts."""

from datetime import datetime

import pytest

from airmart.plans import datasets, marts
from tests.helpers import at, table


@pytest.fixture(scope="module")
def fact(spark):
    weather = table(spark, "weather", [{"h": h, "WIND_SPEED": h % 10} for h in range(24 * 40)])
    air = table(spark, "airquality", [
        {"h": h, "US_AQI": h % 24, "PM2_5": 100 - 2 * (h % 10)} for h in range(24 * 40)
    ])
    return marts.fact_hourly(weather, air).cache()


def test_series_grains(fact):
    def periods(grain):
        rows = datasets.aqi_series(fact, grain).orderBy("PERIOD").collect()
        return [(r.PERIOD, r.N_HOURS) for r in rows]

    assert periods("month") == [(datetime(2024, 1, 1), 744), (datetime(2024, 2, 1), 216)]
    assert periods("week")[0] == (datetime(2024, 1, 1), 168)
    assert len(periods("day")) == 40 and len(periods("hour")) == 960
    day = datasets.aqi_series(fact, "day").first()
    assert (day.AVG_AQI, day.MIN_AQI, day.MAX_AQI) == (11.5, 0.0, 23.0)


def test_heatmap_grid_holds_the_heatmap(fact):
    grid = {r.DAY_NAME: r for r in datasets.heatmap_grid(fact).collect()}
    for cell in datasets.heatmap(fact).collect():
        assert grid[cell.DAY_NAME][str(cell.HOUR_OF_DAY)] == cell.AVG_AQI == cell.HOUR_OF_DAY


def test_wind(fact):
    trend = datasets.wind_trend(fact).first()
    assert trend.CORRELATION == pytest.approx(-1) and trend.SLOPE == pytest.approx(-2)
    bins = {r.WIND_FROM: r.AVG_PM2_5 for r in datasets.wind_bins(fact).collect()}
    assert bins == {0.0: 96.0, 5.0: 86.0}
    drivers = {r.DRIVER: r.CORRELATION for r in datasets.pollution_drivers(fact, ["WIND_SPEED"]).collect()}
    assert drivers["WIND_SPEED"] == pytest.approx(-1)


def test_history_vs_now(spark):
    history = table(spark, "airquality", [
        {"h": 3, "US_AQI": 10}, {"h": 27, "US_AQI": 20}, {"h": 28, "US_AQI": 99},
    ])
    now = table(spark, "airquality", [{"h": 51, "US_AQI": 40}])
    row = datasets.history_vs_now(history, now).first()
    assert (row.OBSERVATION_TIME, row.USUAL_US_AQI, row.GAP_US_AQI, row.N_HOURS) == (at(51), 15.0, 25.0, 2)
    unseen = datasets.history_vs_now(history, table(spark, "airquality", [{"h": 53}])).first()
    assert unseen.USUAL_US_AQI is None
