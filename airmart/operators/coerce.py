"""From payload rows to typed raw rows, and the two time filters of a load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from airmart import schemas as S
from airmart.functions import nullable_double, nullable_int, parse_utc, strict_cast, this_hour
from airmart.functions import time_column


def conform(
    rows: DataFrame, kind: str, keep: tuple[str, ...] = (), strict: bool = False,
    unknown_times: bool = False,
) -> DataFrame:
    """Rename payload fields and cast each measure.

    Missing values become NULL. ``strict`` instead fails the job on a missing
    or malformed measure. A time that is none fails the job, or becomes NULL with
    ``unknown_times``, for the key checks to count.
    """
    columns = []
    for field, name in S.FIELDS[kind].items():
        value = F.col(field)
        if name == S.TIME:
            cast = value.try_cast("timestamp_ntz") if unknown_times else parse_utc(value)
        elif strict:
            cast = strict_cast(value, "int" if name in S.INTEGER_COLUMNS else "double", name)
        else:
            cast = (nullable_int if name in S.INTEGER_COLUMNS else nullable_double)(value)
        columns.append(cast.alias(name))
    return rows.select(*keep, *columns)


def before_cutoff(df: DataFrame, now: datetime | Column) -> DataFrame:
    """History rows: strictly older than one hour before ``now``, minutes kept."""
    return df.where(F.col(S.TIME) < time_column(now) - F.expr("INTERVAL 1 HOUR"))


def current_hour(
    df: DataFrame,
    now: datetime | Column,
    series: tuple[str, ...] = (),
    position: str | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """The row of the running hour, at most one per series.

    Repeated rows resolve to the first by ``position``, then by content. An
    absent hour gives an empty frame; ``observation`` receives the row count as
    ``rows`` so that a caller can warn.
    """
    rows = df.where(F.col(S.TIME) == this_hour(now))
    ranking = [position] if position else []
    ranking += [c for c in df.columns if c not in (*series, *ranking)]
    order = [F.col(c).asc_nulls_last() for c in ranking]
    # Only one hour is left, so time is a constant partition key of the series.
    window = Window.partitionBy(*series, S.TIME).orderBy(*order)
    first = rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1")
    first = first.drop("_rank", *([position] if position else []))
    if observation is not None:
        first = first.observe(observation, F.count(F.lit(1)).alias("rows"))
    return first
