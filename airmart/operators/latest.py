"""Latest k rows, overall or per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airmart.schemas import TIME
from airmart.sources.payload import DELIVERY, POSITION


SALTS = 32
GROUP_LIMIT = 1000  # Spark's own: up to so many rows per key are kept in each map task


def latest_rows(
    df: DataFrame,
    k: int,
    order: list[str],
    series: tuple[str, ...] = (),
    salts: int = SALTS,
) -> DataFrame:
    """The ``k`` rows latest by ``order``; remaining columns break ties.

    Overall: each task keeps k rows and one merges them. Per series each
    map task keeps k rows of a series, so that even one that holds most rows sends k
    rows per task to its final rank. Where k is too large for that, rows are ranked
    within ``salts`` slices of a series first.
    """
    ties = [c for c in df.columns if c not in (*series, *order)]
    latest: list[Column] = [F.col(c).desc_nulls_last() for c in order]
    latest += [F.col(c).asc_nulls_last() for c in ties]
    if not series:
        return df.orderBy(*latest).limit(k)
    if salts > 1 and k > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*order, *ties), F.lit(salts))
        df = _top(df.withColumn("_salt", salt), k, [*series, "_salt"], latest).drop("_salt")
    return _top(df, k, list(series), latest)


def newest_per_hour(rows: DataFrame, series: tuple[str, ...] = ()) -> DataFrame:
    """Of several deliveries of an hour the newest; within one, the first by position."""
    window = Window.partitionBy(*series, TIME).orderBy(F.col(DELIVERY).desc(), F.col(POSITION))
    first = rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1")
    return first.drop("_rank", DELIVERY, POSITION)


def _top(df: DataFrame, k: int, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")
