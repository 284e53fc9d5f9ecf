"""Aggregate tables for dashboards, all with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from airmart import schemas as S
from airmart.functions import trunc_hour

DRIVERS = [c for c in [*S.FACT_WEATHER, *S.FACT_AIR] if c != "PM2_5"]


def _period(grain: str) -> Column:
    if grain == "hour":
        return trunc_hour(F.col(S.TIME))
    date = F.to_date(S.TIME)
    return (date if grain == "day" else F.trunc(date, grain)).cast("timestamp_ntz")


def aqi_series(fact: DataFrame, grain: str = "day", series: tuple[str, ...] = ()) -> DataFrame:
    """AQI and PM2.5 over time; ``grain`` is hour, day, week or month."""
    return fact.groupBy(*series, _period(grain).alias("PERIOD")).agg(
        F.avg("US_AQI").alias("AVG_AQI"),
        F.min("US_AQI").alias("MIN_AQI"),
        F.max("US_AQI").alias("MAX_AQI"),
        F.avg("PM2_5").alias("AVG_PM2_5"),
        F.count(F.lit(1)).alias("N_HOURS"),
    )


def heatmap(fact: DataFrame) -> DataFrame:
    """Average AQI and PM2.5 by weekday and hour."""
    return fact.groupBy("DAY_NAME", "HOUR_OF_DAY").agg(
        F.avg("US_AQI").alias("AVG_AQI"),
        F.avg("PM2_5").alias("AVG_PM2_5"),
        F.count(F.lit(1)).alias("N_HOURS"),
    )


def heatmap_grid(fact: DataFrame) -> DataFrame:
    """The AQI heatmap with one column per hour of the day."""
    return fact.groupBy("DAY_NAME").pivot("HOUR_OF_DAY", list(range(24))).agg(F.avg("US_AQI"))


def anomaly_alerts(detections: DataFrame) -> DataFrame:
    return detections.where("IS_ANOMALY")


def class_predictions(current: DataFrame, historical: DataFrame) -> DataFrame:
    """Both prediction tables under one roof, tagged by origin."""
    return current.withColumn("SOURCE", F.lit("current")).unionByName(
        historical.withColumn("SOURCE", F.lit("historical"))
    )


def wind_points(fact: DataFrame) -> DataFrame:
    """Points of the PM2.5 against wind-speed plot."""
    both = F.col("WIND_SPEED").isNotNull() & F.col("PM2_5").isNotNull()
    return fact.where(both).select(S.TIME, "WIND_SPEED", "PM2_5", "AQI_CATEGORY")


def wind_bins(fact: DataFrame, width: float = 5.0) -> DataFrame:
    """Average PM2.5 per wind-speed bin."""
    bin_ = (F.floor(F.col("WIND_SPEED") / width) * F.lit(width)).alias("WIND_FROM")
    return wind_points(fact).groupBy(bin_).agg(
        F.avg("PM2_5").alias("AVG_PM2_5"), F.count(F.lit(1)).alias("N_HOURS")
    )


def wind_trend(fact: DataFrame) -> DataFrame:
    """Correlation and slope of PM2.5 over wind speed."""
    return wind_points(fact).agg(
        F.corr("WIND_SPEED", "PM2_5").alias("CORRELATION"),
        F.regr_slope("PM2_5", "WIND_SPEED").alias("SLOPE"),
        F.count(F.lit(1)).alias("N_HOURS"),
    )


def by_source(history: DataFrame, now: DataFrame) -> DataFrame:
    """Rows of both loads, tagged by origin."""
    return history.withColumn("SOURCE", F.lit("history")).unionByName(
        now.withColumn("SOURCE", F.lit("realtime"))
    )


def history_vs_now(
    history: DataFrame, now: DataFrame, measures: tuple[str, ...] = ("US_AQI", "PM2_5"),
    series: tuple[str, ...] = (),
) -> DataFrame:
    """Current readings beside the history average of the same hour of day.

    ``history`` and ``now`` are air-quality tables. Only hours of day with a
    current reading are averaged, usually one of the 24.
    """
    hour = F.hour(S.TIME).alias("HOUR_OF_DAY")
    current = now.select(*series, S.TIME, hour, *measures)
    wanted = current.select("HOUR_OF_DAY").distinct()
    usual = (
        history.select(*series, hour, *measures)
        # Distinct hours of day: 24 rows at most.
        .join(F.broadcast(wanted), "HOUR_OF_DAY", "left_semi")
        .groupBy(*series, "HOUR_OF_DAY")
        .agg(*[F.avg(m).alias(f"USUAL_{m}") for m in measures], F.count(F.lit(1)).alias("N_HOURS"))
    )
    compared = current.join(usual, [*series, "HOUR_OF_DAY"], "left")
    gaps = [(F.col(m) - F.col(f"USUAL_{m}")).alias(f"GAP_{m}") for m in measures]
    return compared.select("*", *gaps)


def pollution_drivers(fact: DataFrame, drivers: list[str] = DRIVERS) -> DataFrame:
    """Correlation of every other measure with PM2.5, all in one pass."""
    wide = fact.agg(*[F.corr(d, "PM2_5").alias(d) for d in drivers])
    return wide.unpivot([], drivers, "DRIVER", "CORRELATION")
