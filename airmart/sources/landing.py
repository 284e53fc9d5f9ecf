"""What a landing folder holds by day, and what of it changed since a load.

A history load lands in ``obs_date=YYYY-MM-DD`` folders. Files may come late, come
again with other values, or hold hours of other days than their folder's.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airmart.functions import parse_utc
from airmart.operators.days import is_one_of, span
from airmart.sources.payload import LANDING_DATE, in_request_range


def landed_marks(spark: SparkSession, path: str, now: datetime | Column, kind: str) -> dict[str, str]:
    """A mark of the files of each landing day that a load asks for; it differs if any file does.

    Files are listed, not opened. One row per day reaches the driver.
    """
    files = spark.read.format("binaryFile").load(path)
    if LANDING_DATE not in files.columns:
        return {}
    date = F.col(LANDING_DATE).cast("date")
    wanted = files.where(in_request_range(date, now, kind))
    own = F.xxhash64("path", "length", "modificationTime")
    mark = F.concat_ws("-", F.count("*").cast("string"), F.sum("length").cast("string"), F.hex(F.bit_xor(own)))
    return {r[0]: r[1] for r in wanted.groupBy(date.cast("string")).agg(mark).collect()}


def hour_days(payload: DataFrame) -> dict[str, tuple[str, str]]:
    """First and last day of the hours in each landing folder."""
    times = payload.select(LANDING_DATE, F.explode("hourly.time").alias("t"))
    # Least and greatest of dates are hashed by folder; those of text would be sorted.
    day = F.to_date(parse_utc(F.col("t")))
    spans = times.groupBy(LANDING_DATE).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return {r[0]: (r[1], r[2]) for r in spans.select(*[F.col(c).cast("string") for c in spans.columns]).collect()}


@dataclass(frozen=True)
class LoadPlan:
    """Landing folders to read, days to replace (None: all), and what to remember."""

    folders: set[str]
    days: set[str] | None
    notes: dict

    @property
    def nothing(self) -> bool:
        return self.days is not None and not self.days


def plan_load(
    marks: dict[str, str], spans_of, notes: dict, now: datetime, series: tuple[str, ...]
) -> LoadPlan:
    """Compare a landing with the notes of the last load.

    Days to replace are those whose hours lie in a folder that is new, changed or
    gone, and those that the cutoff has moved over. To read are the folders that hold
    hours of them. ``spans_of`` gives the span of hours of the named folders.
    """
    cutoff = (now - timedelta(hours=1)).isoformat()
    old: dict[str, list] = notes.get("landing", {}) if notes.get("series") == list(series) else {}
    fresh = {d for d, mark in marks.items() if d not in old or old[d][0] != mark}
    found = spans_of(fresh) if fresh else {}
    landing = {d: [marks[d], *(found.get(d) or (None, None))] if d in fresh else old[d] for d in marks}
    new_notes = {"landing": landing, "cutoff": cutoff, "series": list(series)}
    if not old:
        return LoadPlan(set(marks), None, new_notes)
    held = lambda entry: span(*entry[1:]) if entry[1] else set()
    touched = fresh | (old.keys() - marks.keys())
    days = set().union(*[held(old[d]) for d in touched if d in old], *[held(landing[d]) for d in fresh])
    if notes["cutoff"] != cutoff:
        days |= span(notes["cutoff"][:10], cutoff[:10]) & set().union(*map(held, landing.values()))
    folders = fresh | {d for d, entry in landing.items() if held(entry) & days}
    return LoadPlan(folders, days, new_notes)


def of_folders(payload: DataFrame, folders: Iterable[str]) -> DataFrame:
    """Only these landing folders; others are not opened."""
    return payload.where(is_one_of(F.col(LANDING_DATE).cast("string"), folders))
