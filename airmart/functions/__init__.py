"""Column expressions; all of them stay inside JVM code generation."""

from airmart.functions.bands import aqi_band, class_code, next_hour_class, temperature_band
from airmart.functions.numbers import normal_cdf, nullable_double, nullable_int, strict_cast
from airmart.functions.times import calendar_parts, iso_text, parse_utc, this_hour, time_column, trunc_hour

__all__ = [
    "aqi_band", "calendar_parts", "class_code", "iso_text", "next_hour_class", "normal_cdf",
    "nullable_double", "nullable_int", "parse_utc", "strict_cast", "temperature_band",
    "this_hour", "time_column", "trunc_hour",
]
