"""Key checks and the gate in front of the model jobs."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from airmart.functions import this_hour
from airmart.schemas import TIME


class QualityError(RuntimeError):
    """At least one check found failing rows."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count; NULL keys are not compared."""
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(named).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where("n_rows > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def absent_hours(
    df: DataFrame, now: datetime | Column, series: tuple[str, ...] = ()
) -> DataFrame:
    """Series without a row for the running hour, with the last hour they have."""
    here = F.col(TIME) == this_hour(now)
    last = df.groupBy(*series).agg(F.max(TIME).alias("LAST_HOUR"), F.coalesce(F.bool_or(here), F.lit(False)).alias("_here"))
    return last.where("NOT _here").drop("_here")


def check_keys(model: str, df: DataFrame, series: tuple[str, ...] = ()) -> DataFrame:
    """Failures of ``unique`` and ``not_null`` on the key, in one pass.

    One row per check: model, check, failures. A row that lacks any part of its key fails
    ``not_null`` and is compared with no other; ``unique`` counts keys held by several rows.
    """
    keys = [*series, TIME]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    totals = counts.agg(
        F.count(F.when(~missing & (F.col("_n") > 1), F.lit(1))).alias("unique"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("not_null"),
    )
    return totals.unpivot([], ["unique", "not_null"], "check", "failures").select(
        F.lit(model).alias("model"), "check", "failures"
    )


def gate(models: dict[str, DataFrame], series: tuple[str, ...] = ()) -> None:
    """Run all checks in one job and raise if any row fails."""
    checks = [check_keys(name, df, series) for name, df in models.items()]
    # Two rows per model reach the driver, whatever the tables hold.
    results = reduce(DataFrame.unionByName, checks).where("failures > 0").collect()
    if results:
        raise QualityError("; ".join(f"{r.model}: {r.check} failed on {r.failures}" for r in results))
