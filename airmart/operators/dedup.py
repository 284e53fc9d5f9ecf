"""Unite history with the current hour and keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from airmart.schemas import TIME


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ``order``.

    The rank filter lets Spark keep one row per key in each map task, so even a
    key that holds most of the table shuffles one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def unite(
    history: DataFrame,
    realtime: DataFrame,
    dedup: str = "unified",
    series: tuple[str, ...] = (),
) -> DataFrame:
    """UNION ALL of both loads, then one row per key.

    ``unified`` ranks over the whole union, measured rows before forecast ones.
    ``as_written`` ranks inside the realtime branch only, which is what a rank
    filter on the last branch of a union means; history passes unchanged.
    Remaining columns break ties so that the survivor is the same on each run.
    """
    keys = [*series, TIME]
    rest = [c for c in history.columns if c not in keys]
    if dedup == "as_written":
        return history.unionByName(first_per_key(realtime, keys, rest))
    if dedup != "unified":
        raise ValueError(f"unknown dedup mode {dedup!r}")
    both = history.withColumn("_src", F.lit(0)).unionByName(realtime.withColumn("_src", F.lit(1)))
    return first_per_key(both, keys, ["_src", *rest]).drop("_src")
