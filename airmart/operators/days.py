"""Which days of a table a change reaches, so that only these are written again.

A day is text like 2024-05-01. Everything here is a set of days, never of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from airmart.operators.store import Table

DAY_COLUMN = "_day"


def day_text(time: str | Column) -> Column:
    return F.to_date(time).cast("string")


def span(first: str, last: str) -> set[str]:
    """All days from the first to the last."""
    a, b = sorted((date.fromisoformat(first), date.fromisoformat(last)))
    return {(a + timedelta(days=k)).isoformat() for k in range((b - a).days + 1)}


def shifted(days: Iterable[str], hours_after: int, hours_before: int) -> set[str]:
    """Days that hold an hour at most that far after or before one of ``days``."""
    ahead, behind = -(-hours_after // 24), -(-hours_before // 24)
    return {
        (date.fromisoformat(d) + timedelta(days=k)).isoformat() for d in days for k in range(-behind, ahead + 1)
    }


def is_one_of(day: Column, days: Iterable[str]) -> Column:
    return day.isin(sorted(days)) if days else F.lit(False)


def writes_by_day(
    tables: dict[str, Table], read: Callable[[str], DataFrame], time: str
) -> dict[str, list[str]]:
    """Of each day the writes it is made of; tables that are not kept by day are read for theirs."""
    found: dict[str, list[str]] = {}
    for name, table in sorted(tables.items()):
        days: list[str] = []
        if any(p.day is None for p in table.parts):
            # One row per day reaches the driver.
            days = [r[0] for r in read(name).select(F.to_date(time).alias("d")).distinct().select(F.col("d").cast("string")).collect()]
        for part in table.parts:
            for day in [part.day] if part.day else days:
                found.setdefault(day, []).append(f"{name}:{part.v}")
    return found


def changed_days(now: dict[str, list[str]], before: dict[str, list[str]]) -> set[str]:
    return {d for d in now.keys() | before.keys() if now.get(d) != before.get(d)}


def near_days(
    counts: DataFrame, days: Iterable[str], ahead: int, behind: int, series: tuple[str, ...] = ()
) -> set[str]:
    """Days other than ``days`` that hold a row close to them in some series.

    Close are the ``ahead`` rows that follow such a day and the ``behind`` rows before it.
    ``counts`` holds the rows of each series and day (series, _day, n). Between two of
    ``days``, rows are summed up from either end, so no window sees more than the days
    of one series.
    """
    ordered = sorted(days)
    if not ordered:
        return set()
    day = F.col(DAY_COLUMN)
    gap = F.size(F.filter(F.array(*[F.lit(d) for d in ordered]), lambda d: d < day))
    between = counts.where(~is_one_of(day, ordered)).withColumn("_gap", gap)
    own = Window.partitionBy(*series, "_gap").orderBy(DAY_COLUMN)
    before = F.coalesce(F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.coalesce(F.sum("n").over(own.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    measured = between.select(DAY_COLUMN, "_gap", before.alias("_before"), after.alias("_after"))
    follows = (F.col("_gap") > 0) & (F.col("_before") < ahead)
    precedes = (F.col("_gap") < len(ordered)) & (F.col("_after") < behind)
    # One row per day reaches the driver.
    return {r[0] for r in measured.where(follows | precedes).select(DAY_COLUMN).distinct().collect()}
