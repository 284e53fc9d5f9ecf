"""Landed API payloads: one JSON object of parallel hourly arrays per line."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airmart import schemas as S
from airmart.functions import iso_text, time_column
from airmart.operators.coerce import conform

POSITION = "_pos"
DELIVERY = "_delivery"
LANDING_DATE = "obs_date"


def request_range(now: datetime | Column, kind: str) -> tuple[Column, Column]:
    """First and last observation date of a history load.

    Weather asks up to today; air quality up to the date of one hour ago.
    """
    end = time_column(now)
    if kind == "airquality":
        end = end - F.expr("INTERVAL 1 HOUR")
    return F.lit(S.HISTORY_START).cast("date"), F.to_date(end)


def in_request_range(date: Column, now: datetime | Column, kind: str) -> Column:
    first, last = request_range(now, kind)
    return date.between(first, last)


def read_landing(
    spark: SparkSession,
    path: str,
    kind: str,
    now: datetime | Column | None = None,
    date_column: str = LANDING_DATE,
    series: tuple[str, ...] = (),
    multi_line: bool = False,
    keep_date: bool = False,
    delivery: bool = False,
) -> DataFrame:
    """Payload rows of a landing folder.

    With ``now`` the folder is expected in ``obs_date=YYYY-MM-DD`` folders and
    only those a history load would request are read. Files hold one object per
    line; ``multi_line`` reads one object per file however it is laid out.
    ``delivery`` adds when and under which name a file was landed, later files
    being greater.
    """
    reader = spark.read.option("multiLine", multi_line)
    schema = S.payload_schema(kind, series)
    landed = F.struct("_metadata.file_modification_time", "_metadata.file_name")
    tag = (lambda df: df.withColumn(DELIVERY, landed)) if delivery else (lambda df: df)
    if now is None:
        return tag(reader.schema(schema).json(path))
    dated = tag(reader.schema(schema.add(date_column, "date")).json(path))
    wanted = dated.where(in_request_range(F.col(date_column), now, kind))
    return wanted if keep_date else wanted.drop(date_column)


def newest_delivery(payload: DataFrame, series: tuple[str, ...] = ()) -> DataFrame:
    """The payload landed last, for each series."""
    last = payload.groupBy(*series).agg(F.max_by(F.struct("hourly"), DELIVERY).alias("_last"))
    # Without any payload a plain aggregate still gives one row.
    return last.where("_last IS NOT NULL").select(*series, "_last.hourly")


def refused_unless_whole(kind: str, value: Column) -> Column:
    """``value``, or an error where a payload is damaged, lacks a field or has arrays of unequal length."""
    sizes = [F.size(F.col(f"hourly.{field}")) for field in S.FIELDS[kind]]
    whole = F.coalesce(F.greatest(*sizes) == F.least(*sizes), F.lit(False))
    for field in S.FIELDS[kind]:
        whole = whole & F.col(f"hourly.{field}").isNotNull()
    problem = F.lit(f"{kind} payload refused: it is damaged, lacks a field or has arrays of unequal length")
    return F.when(whole, value).otherwise(F.raise_error(problem))


def explode_hourly(
    payload: DataFrame, kind: str, series: tuple[str, ...] = (), position: bool = False
) -> DataFrame:
    """One row per hour from parallel arrays, still under the payload names.

    A payload that is not whole fails the job, so that what it would replace
    stays. ``position`` keeps the place inside the payload, which decides between
    repeated hours.
    """
    arrays = [F.col(f"hourly.{field}").alias(field) for field in S.FIELDS[kind]]
    zipped = refused_unless_whole(kind, F.arrays_zip(*arrays))
    keep = [F.col(s) for s in series]
    if position:
        rows = payload.select(*keep, F.posexplode(zipped).alias(POSITION, "_hour"))
        return rows.select(*keep, POSITION, "_hour.*")
    return payload.select(*keep, F.inline(zipped))


def hourly_table(
    payload: DataFrame,
    kind: str,
    series: tuple[str, ...] = (),
    strict: bool = False,
    position: bool = False,
) -> DataFrame:
    """Typed raw rows: exploded, renamed and cast."""
    rows = explode_hourly(payload, kind, series, position)
    extra = (*series, POSITION) if position else series
    return conform(rows, kind, extra, strict)


def to_payload(table: DataFrame, kind: str, group: list[Column]) -> DataFrame:
    """Inverse of ``hourly_table``: parallel arrays, one object per group.

    ``group`` must bound the rows per object, such as station and day.
    """
    columns = S.FIELDS[kind]
    entry = F.struct(*[F.col(c).alias(f) for f, c in columns.items()])
    packed = table.groupBy(*group).agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    arrays = [
        (F.transform(f"_rows.{f}", lambda t: iso_text(t, seconds=False))
         if f == "time" else F.col(f"_rows.{f}")).alias(f)
        for f in columns
    ]
    return packed.withColumn("hourly", F.struct(*arrays)).drop("_rows")
