"""Rules that are easy to change by accident."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from airmart.functions import (
    aqi_band, calendar_parts, class_code, iso_text, next_hour_class, normal_cdf, parse_utc,
    temperature_band, this_hour, trunc_hour,
)
from airmart.operators.coerce import before_cutoff, conform, current_hour
from airmart.operators.dedup import unite
from airmart.operators.latest import latest_rows
from airmart.plans import marts
from airmart.sources.payload import request_range
from tests.helpers import at, column, table


def values(spark, numbers, make):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, v double")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_aqi_bands(spark):
    got = values(spark, [0.0, 50.0, 50.5, 100.0, 100.1, 150.0, 200.0, 300.0, 300.1, None], aqi_band)
    assert got == [
        "Good", "Good", "Moderate", "Moderate", "Unhealthy for Sensitive",
        "Unhealthy for Sensitive", "Unhealthy", "Very Unhealthy", "Hazardous", "Hazardous",
    ]


def test_temperature_bands(spark):
    got = values(spark, [35.0, 34.9, 5.0, 5.1, None], temperature_band)
    assert got == ["Extreme Heat", "Normal", "Freezing", "Normal", "Normal"]


def test_unknown_label_is_optional(spark):
    assert values(spark, [None, 10.0], lambda c: aqi_band(c, "Unknown")) == ["Unknown", "Good"]
    assert values(spark, [None], lambda c: temperature_band(c, "Unknown")) == ["Unknown"]


def test_class_codes(spark):
    got = values(spark, [40.0, 60.0, 120.0, None], lambda c: class_code(next_hour_class(c)))
    assert got == [0, 1, 2, 2]


def test_calendar_parts(spark):
    df = table(spark, "weather", [{"h": 13}])
    row = df.select(*[c.alias(n) for n, c in calendar_parts().items()]).first()
    assert row.asDict() == {
        "DATE_ONLY": date(2024, 1, 1), "MONTH_NAME": "Jan", "HOUR_OF_DAY": 13, "DAY_NAME": "Mon",
    }


def test_times(spark):
    df = spark.createDataFrame([("2024-03-10T02:30",), ("2024-03-10T02:30:15",)], "t string")
    parsed = df.select(parse_utc(F.col("t")).alias("t"))
    assert [r[0] for r in parsed.select(trunc_hour(F.col("t"))).collect()] == [datetime(2024, 3, 10, 2)] * 2
    assert {r[0] for r in parsed.select(iso_text(F.col("t"))).collect()} == {
        "2024-03-10T02:30:00", "2024-03-10T02:30:15",
    }
    now = datetime(2024, 3, 10, 2, 59, tzinfo=timezone.utc)
    assert spark.range(1).select(this_hour(now)).first()[0] == datetime(2024, 3, 10, 2)


def test_times_ignore_the_session_zone(spark):
    """02:30 does not exist in New York on this day; zone-free times must not care."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_times(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_normal_cdf(spark):
    from statistics import NormalDist

    points = [x / 8 for x in range(-40, 41)]
    got = values(spark, points, normal_cdf)
    assert max(abs(a - NormalDist().cdf(x)) for a, x in zip(got, points)) < 1.5e-7


def test_cutoff_is_strict_and_keeps_minutes(spark):
    hours = table(spark, "weather", [{"h": h} for h in range(24)])
    assert max(column(before_cutoff(hours, at(14.5)), "OBSERVATION_TIME")) == at(13)
    assert max(column(before_cutoff(hours, at(14)), "OBSERVATION_TIME")) == at(12)


def test_request_range(spark):
    def bounds(kind):
        return spark.range(1).select(*request_range(datetime(2024, 1, 5, 0, 20), kind)).first()

    assert tuple(bounds("weather")) == (date(2022, 9, 1), date(2024, 1, 5))
    assert tuple(bounds("airquality")) == (date(2022, 9, 1), date(2024, 1, 4))


def test_missing_measures_become_null(spark):
    row = {"time": "2024-01-01T05:00", "pm10": float("nan"), "pm2_5": None}
    names = ["carbon_monoxide", "nitrogen_dioxide", "ozone", "sulphur_dioxide", "us_aqi",
             "uv_index", "dust"]
    df = spark.createDataFrame(
        [(row["time"], row["pm10"], row["pm2_5"], *[2.0] * 7)],
        "time string, pm10 double, pm2_5 double, " + ", ".join(f"{n} double" for n in names),
    )
    got = conform(df, "airquality").first()
    assert got.PM10 is None and got.PM2_5 is None and got.DUST == 2.0


def _weather_wire(spark, flag):
    from airmart.schemas import WEATHER_FIELDS

    fields = list(WEATHER_FIELDS)
    schema = ", ".join(f"{f} {'string' if f == 'time' else 'double'}" for f in fields)
    row = ["2024-01-01T05:00"] + [3.0] * (len(fields) - 1)
    row[fields.index("is_day")] = flag
    return spark.createDataFrame([tuple(row)], schema)


def test_flag_is_an_integer_or_null(spark):
    assert conform(_weather_wire(spark, 1.0), "weather").first().IS_DAY_FLAG == 1
    assert conform(_weather_wire(spark, float("nan")), "weather").first().IS_DAY_FLAG is None


def test_strict_mode_fails_on_a_missing_measure(spark):
    assert conform(_weather_wire(spark, 0.0), "weather", strict=True).first().IS_DAY_FLAG == 0
    for bad in (None, float("nan")):
        with pytest.raises(Exception, match="IS_DAY_FLAG is missing"):
            conform(_weather_wire(spark, bad), "weather", strict=True).collect()


def test_current_hour_takes_the_first_in_payload_order(spark):
    rows = table(spark, "weather", [
        {"h": 3, "TEMPERATURE": 9}, {"h": 4, "TEMPERATURE": 8}, {"h": 4, "TEMPERATURE": 2},
    ]).withColumn("_pos", F.when(F.col("TEMPERATURE") == 8, 0).otherwise(1))
    got = current_hour(rows, at(4.7), position="_pos").collect()
    assert [r.TEMPERATURE for r in got] == [8.0]
    assert current_hour(rows, at(9), position="_pos").count() == 0


def test_current_hour_reports_an_absent_hour(spark):
    from pyspark.sql import Observation

    seen = Observation()
    rows = table(spark, "weather", [{"h": 3}])
    current_hour(rows, at(9), observation=seen).collect()
    assert seen.get.get("rows", 0) == 0


def _overlap(spark):
    history = table(spark, "weather", [
        {"h": 1, "TEMPERATURE": 5}, {"h": 1, "TEMPERATURE": 4}, {"h": 2, "TEMPERATURE": 7},
    ])
    realtime = table(spark, "weather", [{"h": 2, "TEMPERATURE": 1}, {"h": 2, "TEMPERATURE": 0}])
    return history, realtime


def test_unified_dedup_prefers_history(spark):
    got = unite(*_overlap(spark)).orderBy("OBSERVATION_TIME")
    assert [(r.OBSERVATION_TIME, r.TEMPERATURE) for r in got.collect()] == [(at(1), 4.0), (at(2), 7.0)]


def test_as_written_dedup_touches_realtime_only(spark):
    got = unite(*_overlap(spark), dedup="as_written")
    assert sorted(r.TEMPERATURE for r in got.collect()) == [0.0, 4.0, 5.0, 7.0]


def test_dedup_is_idempotent(spark):
    history, realtime = _overlap(spark)
    once = unite(history, realtime)
    again = unite(once, realtime)
    assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0


def _training(spark, air, **options):
    weather = table(spark, "weather", [{"h": r["h"]} for r in air])
    return marts.classifier_training(weather, table(spark, "airquality", air), **options)


@pytest.mark.parametrize("strategy", ["series", "blocked"])
def test_unknown_next_reading_is_poor(spark, strategy):
    air = [{"h": h, "PM2_5": h + 1, "US_AQI": q} for h, q in enumerate([40.0, 60.0, 120.0, None])]
    mart = _training(spark, air, strategy=strategy)
    assert column(mart, "OBSERVATION_TIME") == [at(2), at(3)]
    assert column(mart, "NEXT_HOUR_CLASS") == ["Poor", "Poor"]
    strict = _training(spark, air, strategy=strategy, strict_label=True)
    assert strict.count() == 0  # hours 2 and 3 have no known next reading


@pytest.mark.parametrize("strategy", ["series", "blocked"])
def test_rolling_average_spans_25_rows(spark, strategy):
    mart = _training(spark, [{"h": h, "PM2_5": h + 1} for h in range(30)], strategy=strategy)
    assert column(mart, "PM25_ROLL24")[-1] == pytest.approx(18.0)


def test_lags_go_by_row_not_by_hour(spark):
    mart = _training(spark, [{"h": h, "PM2_5": v} for h, v in ((0, 10), (1, 11), (5, 12))])
    assert column(mart, "PM25_LAG1") == [11.0]


def test_training_skips_missing_pm_but_inference_does_not(spark):
    air = [{"h": h, "PM2_5": v} for h, v in enumerate([1.0, None, 3.0, 4.0])]
    mart = _training(spark, air)
    assert column(mart, "PM25_LAG1") == [3.0] and column(mart, "PM25_LAG2") == [1.0]
    weather = table(spark, "weather", [{"h": h} for h in range(4)])
    empty = table(spark, "weather", []), table(spark, "airquality", [])
    row = marts.classifier_inference(weather, table(spark, "airquality", air), *empty).first()
    assert (row.PM25_LAG1, row.PM25_LAG2) == (3.0, None)
    assert row.PM25_ROLL24 == pytest.approx(8 / 3)


def test_inference_prefers_the_current_hour_and_falls_back_to_history(spark):
    weather = table(spark, "weather", [{"h": h, "TEMPERATURE": h} for h in range(60)])
    air = table(spark, "airquality", [{"h": h, "PM2_5": h} for h in range(60)])
    now_w = table(spark, "weather", [{"h": 59, "TEMPERATURE": 99}])
    now_a = table(spark, "airquality", [{"h": 59, "PM2_5": 99}])
    row = marts.classifier_inference(weather, air, now_w, now_a, diagnostics=True).first()
    assert row.IS_REALTIME and row.TEMPERATURE == 99.0 and row.PM25_LAG1 == 59.0
    none_w, none_a = table(spark, "weather", []), table(spark, "airquality", [])
    row = marts.classifier_inference(weather, air, none_w, none_a, diagnostics=True).first()
    assert not row.IS_REALTIME and row.OBSERVATION_TIME == at(59)


def test_recent_history_counts_joined_rows(spark):
    """48 joined rows, however far back they lie."""
    weather = table(spark, "weather", [{"h": h} for h in range(300)])
    air = table(spark, "airquality", [{"h": h * 3, "PM2_5": h} for h in range(100)])
    joined = marts.common_hours(weather, air, ["PM2_5", "US_AQI"])
    kept = latest_rows(joined, 48, ["OBSERVATION_TIME"])
    assert sorted(column(kept, "PM2_5")) == [float(h) for h in range(52, 100)]


def test_latest_rows_per_series_match_a_plain_rank(spark):
    rows = [{"h": h, "station": s} for s, n in (("hot", 400), ("b", 5), ("c", 1)) for h in range(n)]
    df = table(spark, "weather", rows, ("station",))
    for salts in (32, 1, 7):
        got = latest_rows(df, 48, ["OBSERVATION_TIME"], ("station",), salts)
        counts = {r.station: (r.n, r.first) for r in got.groupBy("station").agg(
            F.count("*").alias("n"), F.min("OBSERVATION_TIME").alias("first")).collect()}
        assert counts == {"hot": (48, at(352)), "b": (5, at(0)), "c": (1, at(0))}


def test_fact_keeps_all_weather_hours_and_drops_air_only_hours(spark):
    weather = table(spark, "weather", [{"h": 0}, {"h": 1}])
    air = table(spark, "airquality", [{"h": 1, "US_AQI": 10}, {"h": 2}])
    fact = marts.fact_hourly(weather, air)
    assert len(fact.columns) == 29
    assert column(fact, "AQI_CATEGORY") == ["Hazardous", "Good"]
    labelled = marts.fact_hourly(weather, air, unknown_label="Unknown")
    assert column(labelled, "AQI_CATEGORY") == ["Unknown", "Good"]


def test_repeated_keys_multiply_in_joins_and_null_keys_never_match(spark):
    weather = table(spark, "weather", [{"h": 1}, {"h": 1}, {"h": None}])
    air = table(spark, "airquality", [{"h": 1}, {"h": 1}, {"h": None}])
    assert marts.anomaly_rows(weather, air).count() == 4
    assert marts.fact_hourly(weather, air).count() == 5


def test_anomaly_rows_drop_missing_pm(spark):
    weather = table(spark, "weather", [{"h": h} for h in range(3)])
    air = table(spark, "airquality", [{"h": 0, "PM2_5": None}, {"h": 1}, {"h": 2}])
    mart = marts.anomaly_rows(weather, air)
    assert mart.columns == [
        "TS", "TEMPERATURE", "HUMIDITY", "WIND_SPEED", "PRESSURE", "PM2_5", "PM10", "US_AQI",
    ]
    assert column(mart, "TS", "TS") == [at(1), at(2)]


def test_recent_hours_are_counted_after_the_join(spark):
    for step in (1, 9, 200):
        hours = [-step * i for i in range(120)]
        weather = table(spark, "weather", [{"h": h, "TEMPERATURE": h} for h in hours])
        air = table(spark, "airquality", [{"h": h} for h in hours if h % 2 == 0])
        recent = marts.recent_common_hours(weather, air)
        wanted = sorted((h for h in hours if h % 2 == 0), reverse=True)[:48]
        assert sorted(column(recent, "OBSERVATION_TIME"), reverse=True) == [at(h) for h in wanted]
