"""Fact table and the four model tables.

Each function takes raw or staged tables and returns a lazy DataFrame. With
``series`` columns every key gains them; without, the table is one series.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from airmart import schemas as S
from airmart.functions import (
    aqi_band, calendar_parts, next_hour_class, temperature_band,
)
from airmart.operators.latest import latest_rows
from airmart.operators.windows import Features, TimeFeatures, blocked_by_time, with_windows

ROLL_ROWS = 25  # fixed value: the current row and 24 before it
RECENT_ROWS = 48  # fixed value: history rows kept for scoring


def fact_hourly(
    weather: DataFrame,
    air: DataFrame,
    series: tuple[str, ...] = (),
    unknown_label: str | None = None,
) -> DataFrame:
    """All weather hours with the air quality of the same hour, if any."""
    joined = weather.join(air, [*series, S.TIME], "left")
    parts = [column.alias(name) for name, column in calendar_parts().items()]
    return joined.select(
        *series,
        S.TIME,
        *parts,
        *S.FACT_WEATHER,
        *S.FACT_AIR,
        aqi_band(F.col("US_AQI"), unknown_label).alias("AQI_CATEGORY"),
        temperature_band(F.col("TEMPERATURE"), unknown_label).alias("TEMP_CATEGORY"),
    )


def common_hours(
    weather: DataFrame,
    air: DataFrame,
    air_columns: list[str],
    series: tuple[str, ...] = (),
    time_name: str = S.TIME,
) -> DataFrame:
    """Hours both tables have, with the weather columns the models use."""
    keys = [*series, S.TIME]
    left = weather.select(*keys, *S.CLASSIFIER_WEATHER)
    right = air.select(*keys, *air_columns)
    return left.join(right, keys, "inner").select(
        *series, F.col(S.TIME).alias(time_name), *S.CLASSIFIER_WEATHER, *air_columns
    )


def pm_features(extra: bool = False, roll_rows: int = ROLL_ROWS) -> Features:
    """Lag and rolling columns; ``extra`` adds wind lag and temperature average."""
    roll = -(roll_rows - 1)
    features: Features = {
        "PM25_LAG1": lambda w: F.lag("PM2_5", 1).over(w),
        "PM25_LAG2": lambda w: F.lag("PM2_5", 2).over(w),
        "PM25_ROLL24": lambda w: F.avg("PM2_5").over(w.rowsBetween(roll, 0)),
    }
    if extra:
        features["WIND_SPEED_LAG1"] = lambda w: F.lag("WIND_SPEED", 1).over(w)
        features["TEMP_ROLL24"] = lambda w: F.avg("TEMPERATURE").over(w.rowsBetween(roll, 0))
    return features


def time_features(extra: bool = False, roll_rows: int = ROLL_ROWS) -> TimeFeatures:
    """The same columns by the clock: a lag is the reading exactly that many hours ago, or none."""
    hour, none = timedelta(hours=1), timedelta(0)
    features: TimeFeatures = {
        "PM25_LAG1": lambda frame: F.max("PM2_5").over(frame(-hour, -hour)),
        "PM25_LAG2": lambda frame: F.max("PM2_5").over(frame(-2 * hour, -2 * hour)),
        "PM25_ROLL24": lambda frame: F.avg("PM2_5").over(frame(-(roll_rows - 1) * hour, none)),
        "_next_aqi": lambda frame: F.max("US_AQI").over(frame(hour, hour)),
    }
    if extra:
        features["WIND_SPEED_LAG1"] = lambda frame: F.max("WIND_SPEED").over(frame(-hour, -hour))
        features["TEMP_ROLL24"] = lambda frame: F.avg("TEMPERATURE").over(frame(-(roll_rows - 1) * hour, none))
    return features


def classifier_training(
    weather: DataFrame,
    air: DataFrame,
    series: tuple[str, ...] = (),
    strategy: str = "blocked",
    strict_label: bool = False,
    extra_features: bool = False,
    time_based: bool = False,
    roll_rows: int = ROLL_ROWS,
    **blocks: int | None,
) -> DataFrame:
    """Features of each history hour and the class of the next one."""
    joined = common_hours(weather, air, S.CLASSIFIER_AIR, series)
    return classifier_rows(
        joined, series, strategy, strict_label, extra_features, time_based, roll_rows, **blocks
    )


def classifier_rows(
    joined: DataFrame,
    series: tuple[str, ...] = (),
    strategy: str = "blocked",
    strict_label: bool = False,
    extra_features: bool = False,
    time_based: bool = False,
    roll_rows: int = ROLL_ROWS,
    **blocks: int | None,
) -> DataFrame:
    """Training rows from common hours.

    Hours without PM2.5 leave before the windows, so lags and averages step
    over them. An unknown next reading counts as the last class; with
    ``strict_label`` such rows are dropped instead. ``time_based`` frames go by the
    clock: an hour that is absent is missed and not stepped over.
    """
    base = joined.where(F.col("PM2_5").isNotNull())
    if time_based:
        reach = timedelta(hours=max(2, roll_rows - 1))
        features = time_features(extra_features, roll_rows)
        windowed = blocked_by_time(base, features, S.TIME, series, reach, timedelta(hours=1), **blocks)
    else:
        by_row = {
            **pm_features(extra_features, roll_rows),
            "_next_aqi": lambda w: F.lead("US_AQI", 1).over(w),
        }
        windowed = with_windows(
            base, by_row, [S.TIME], series, preceding=max(2, roll_rows - 1), following=1,
            strategy=strategy, **blocks,
        )
    label = next_hour_class(F.col("_next_aqi"), strict_label)
    return (
        windowed.withColumn("NEXT_HOUR_CLASS", label)
        .drop("_next_aqi")
        .where(F.col("PM25_LAG2").isNotNull() & F.col("NEXT_HOUR_CLASS").isNotNull())
    )


def recent_common_hours(
    weather: DataFrame,
    air: DataFrame,
    series: tuple[str, ...] = (),
) -> DataFrame:
    """The latest ``RECENT_ROWS`` common hours, counted after the join."""
    joined = common_hours(weather, air, S.CLASSIFIER_AIR, series)
    return latest_rows(joined, RECENT_ROWS, [S.TIME], series)


def classifier_inference(
    weather_history: DataFrame,
    air_history: DataFrame,
    weather_now: DataFrame,
    air_now: DataFrame,
    series: tuple[str, ...] = (),
    extra_features: bool = False,
    diagnostics: bool = False,
) -> DataFrame:
    """Features of the latest row of recent history plus the current hour.

    When no current hour was loaded the latest row is a history row;
    ``diagnostics`` adds ``IS_REALTIME`` to tell them apart. When both hold the
    same hour the current one wins.
    """
    recent = recent_common_hours(weather_history, air_history, series)
    current = common_hours(weather_now, air_now, S.CLASSIFIER_AIR, series)
    return newest_features(recent, current, series, extra_features, diagnostics)


def newest_features(
    recent: DataFrame,
    current: DataFrame,
    series: tuple[str, ...] = (),
    extra_features: bool = False,
    diagnostics: bool = False,
) -> DataFrame:
    """As ``classifier_inference``, from recent and current common hours."""
    rows = recent.withColumn("IS_REALTIME", F.lit(False)).unionByName(
        current.withColumn("IS_REALTIME", F.lit(True))
    )
    # At most RECENT_ROWS history rows per series, so one window task per series is bounded.
    windowed = with_windows(
        rows, pm_features(extra_features), [S.TIME, "IS_REALTIME"], series, strategy="series"
    )
    newest = [F.col(c).desc_nulls_last() for c in (S.TIME, "IS_REALTIME")]
    newest += [F.col(c).desc_nulls_last() for c in (*S.CLASSIFIER_WEATHER, *S.CLASSIFIER_AIR)]
    rank = F.row_number().over(Window.partitionBy(*series).orderBy(*newest))
    last = windowed.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return last if diagnostics else last.drop("IS_REALTIME")


def anomaly_rows(
    weather: DataFrame, air: DataFrame, series: tuple[str, ...] = ()
) -> DataFrame:
    """Detector rows: common hours with a PM2.5 reading, time named ``TS``.

    Serves training on history and scoring on the current hour alike.
    """
    return with_reading(common_hours(weather, air, S.ANOMALY_AIR, series, time_name="TS"))


def with_reading(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("PM2_5").isNotNull())
