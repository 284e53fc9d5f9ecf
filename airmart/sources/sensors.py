"""Reads an event table as if it were hourly sensor series.

``events(event_id, ts, user_id, event_type, value)`` stands in for the weather
and air-quality feeds: each measure is the least or greatest ``value`` of one
event type within the hour. Least and greatest, unlike sums, do not depend on
row order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airmart import schemas as S
from airmart.functions import this_hour, trunc_hour
from airmart.operators.coerce import before_cutoff

# measure -> (aggregate, event type; "any" for all types)
WEATHER_SIGNALS = {
    "TEMPERATURE": ("max", "view"),
    "HUMIDITY": ("min", "view"),
    "DEW_POINT": ("min", "click"),
    "FEELS_LIKE_TEMP": ("max", "click"),
    "PRECIPITATION_TOTAL": ("min", "purchase"),
    "RAIN": ("max", "purchase"),
    "CLOUD_COVER": ("min", "signup"),
    "WIND_SPEED": ("max", "signup"),
    "WIND_GUSTS": ("max", "any"),
    "WIND_DIRECTION": ("min", "any"),
    "PRESSURE": ("max", "purchase"),
    "SOLAR_RADIATION": ("max", "error"),
}
AIR_SIGNALS = {
    "PM10": ("min", "any"),
    "PM2_5": ("min", "error"),
    "CARBON_MONOXIDE": ("max", "click"),
    "NITROGEN_DIOXIDE": ("min", "click"),
    "OZONE": ("max", "purchase"),
    "SULPHUR_DIOXIDE": ("min", "purchase"),
    "US_AQI": ("max", "error"),
    "UV_INDEX": ("max", "signup"),
    "DUST": ("min", "signup"),
}
# Sensor drop-outs: a reading is NULL in hours whose event count is a multiple.
DROPOUTS = {"PM2_5": 7, "US_AQI": 5}

STATION = "station"


@dataclass(frozen=True)
class Feeds:
    """Four raw tables and the instant they were loaded at."""

    weather_history: DataFrame
    air_history: DataFrame
    weather_now: DataFrame
    air_now: DataFrame
    now: Column


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


_HOUR = "to_date(ts)::timestamp_ntz + make_dt_interval(0, hour(ts))"
_DAYLIGHT = "int(hour(ts) BETWEEN 6 AND 17)"


def _signals(kind: str, station: bool) -> str:
    """Select list with one aggregate per measure."""
    # Station hours hold about one event, so there the model columns take any type.
    modelled = {*S.CLASSIFIER_WEATHER, *S.ANOMALY_AIR} if station else set()
    columns = []
    for name, (aggregate, event) in (WEATHER_SIGNALS if kind == "weather" else AIR_SIGNALS).items():
        every = event == "any" or name in modelled
        condition = "" if every else f" FILTER (WHERE event_type = '{event}')"
        columns.append(f"{aggregate}(value){condition} AS {name}")
    if kind == "weather":
        columns.append(f"max({_DAYLIGHT}) AS IS_DAY_FLAG")
    return ", ".join(columns)


def weather_hours(events: DataFrame) -> DataFrame:
    """One row per hour with at least one ``view`` event."""
    hours = events.sparkSession.sql(
        f"""SELECT {_HOUR} AS {S.TIME}, {_signals("weather", False)} FROM {{events}}
        GROUP BY 1 HAVING count_if(event_type = 'view') > 0""",
        events=events,
    )
    return hours.select(*S.WEATHER_COLUMNS)


def air_hours(events: DataFrame) -> DataFrame:
    """One row per hour with at least one ``error`` event."""
    drop = ", ".join(f"if(_n % {n} <> 0, {c}, NULL) AS {c}" for c, n in DROPOUTS.items())
    kept = ", ".join(c for c in S.AIR_COLUMNS if c not in DROPOUTS)
    hours = events.sparkSession.sql(
        f"""SELECT {kept}, {drop} FROM (
          SELECT {_HOUR} AS {S.TIME}, {_signals("airquality", False)},
            count_if(event_type = 'error') AS _n
          FROM {{events}} GROUP BY 1)
        WHERE _n > 0""",
        events=events,
    )
    return hours.select(*S.AIR_COLUMNS)


def station_weather(events: DataFrame) -> DataFrame:
    """One row per station and hour with any event."""
    hours = events.sparkSession.sql(
        f"""SELECT string(user_id) AS {STATION}, {_HOUR} AS {S.TIME}, {_signals("weather", True)}
        FROM {{events}} GROUP BY 1, 2""",
        events=events,
    )
    return hours.select(STATION, *S.WEATHER_COLUMNS)


def station_air(events: DataFrame) -> DataFrame:
    """One row per station and hour with any event but a ``view``.

    Stations only report PM2.5 in hours with something besides clicks.
    """
    kept = ", ".join(c for c in S.AIR_COLUMNS if c != "PM2_5")
    hours = events.sparkSession.sql(
        f"""SELECT {STATION}, {kept}, if(_n > 0, PM2_5, NULL) AS PM2_5 FROM (
          SELECT string(user_id) AS {STATION}, {_HOUR} AS {S.TIME},
            {_signals("airquality", True)}, count_if(event_type <> 'click') AS _n
          FROM {{events}} WHERE event_type <> 'view' GROUP BY 1, 2)""",
        events=events,
    )
    return hours.select(STATION, *S.AIR_COLUMNS)


def event_weather(events: DataFrame) -> DataFrame:
    """The long series: each event is one observation of every weather measure."""
    columns = {**dict.fromkeys(WEATHER_SIGNALS, "value"), "IS_DAY_FLAG": _DAYLIGHT}
    return events.selectExpr(
        f"ts AS {S.TIME}", *[f"{columns[c]} AS {c}" for c in S.WEATHER_MEASURES]
    )


def event_air(events: DataFrame) -> DataFrame:
    """Air side of the long series; ``signup`` events carry no PM2.5 reading."""
    columns = dict.fromkeys(AIR_SIGNALS, "value")
    columns["PM2_5"] = "if(event_type <> 'signup', value, NULL)"
    columns["US_AQI"] = "value * 2"
    return events.selectExpr(f"ts AS {S.TIME}", *[f"{columns[c]} AS {c}" for c in S.AIR_MEASURES])


def load_time(events: DataFrame) -> Column:
    """Half past the latest hour, as a scalar subquery: no value reaches the driver."""
    latest = events.agg(trunc_hour(F.max("ts")).alias("latest")).scalar()
    return latest + F.expr("INTERVAL 30 MINUTES")


def split_feeds(events: DataFrame, weather: DataFrame, air: DataFrame) -> Feeds:
    """History before the latest hour, realtime at it."""
    now = load_time(events)
    here = F.col(S.TIME) == this_hour(now)
    return Feeds(
        before_cutoff(weather, now), before_cutoff(air, now), weather.where(here),
        air.where(here), now,
    )


def hourly_feeds(events: DataFrame) -> Feeds:
    return split_feeds(events, weather_hours(events), air_hours(events))


def station_feeds(events: DataFrame) -> Feeds:
    return split_feeds(events, station_weather(events), station_air(events))
