"""Time expressions on zone-free UTC timestamps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from airmart.schemas import TIME


def time_column(now: datetime | Column) -> Column:
    """``now`` as a zone-free UTC column; columns pass through."""
    if isinstance(now, Column):
        return now
    if now.tzinfo is not None:
        now = now.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_utc(text: Column) -> Column:
    """ISO text with or without seconds to a zone-free timestamp."""
    return text.cast("timestamp_ntz")


def iso_text(ts: Column, seconds: bool = True) -> Column:
    """ISO text; cut from the plain cast, since a formatter would apply the session zone."""
    return F.replace(F.substring(ts.cast("string"), 1, 19 if seconds else 16), F.lit(" "), F.lit("T"))


def trunc_hour(ts: Column) -> Column:
    """Start of the hour; built from zone-free parts, so no session zone enters."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def this_hour(now: datetime | Column) -> Column:
    return trunc_hour(time_column(now))


# As monthname and dayname give them, which make a formatter for every row.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _named(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), number)


def calendar_parts(ts: Column | None = None) -> dict[str, Column]:
    """Date, month name, hour and weekday name of ``ts``."""
    ts = F.col(TIME) if ts is None else ts
    return {
        "DATE_ONLY": F.to_date(ts),
        "MONTH_NAME": _named(MONTHS, F.month(ts)),
        "HOUR_OF_DAY": F.hour(ts),
        "DAY_NAME": _named(WEEKDAYS, F.weekday(ts) + 1),
    }
