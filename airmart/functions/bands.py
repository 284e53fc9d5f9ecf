"""Category labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from airmart import schemas as S


def _upto(value: Column, bands, above: str, unknown: str | None) -> Column:
    """Label of the first band whose upper limit holds ``value``.

    NULL compares as unknown in every branch and so ends in ``above``, unless
    ``unknown`` names a label of its own.
    """
    label = F.when(value.isNull(), F.lit(unknown)) if unknown is not None else F
    for limit, name in bands:
        label = label.when(value <= limit, F.lit(name))
    return label.otherwise(F.lit(above))


def aqi_band(aqi: Column, unknown: str | None = None) -> Column:
    return _upto(aqi, S.AQI_BANDS, S.AQI_BAND_ABOVE, unknown)


def temperature_band(celsius: Column, unknown: str | None = None) -> Column:
    label = F.when(celsius.isNull(), F.lit(unknown)) if unknown is not None else F
    return (
        label.when(celsius >= S.HEAT_FROM, F.lit(S.HEAT_LABEL))
        .when(celsius <= S.FROST_UPTO, F.lit(S.FROST_LABEL))
        .otherwise(F.lit(S.NORMAL_LABEL))
    )


def next_hour_class(next_aqi: Column, strict: bool = False) -> Column:
    """Class of the following reading; ``strict`` leaves an unknown reading NULL."""
    label = _upto(next_aqi, S.NEXT_CLASS_BANDS, S.NEXT_CLASS_ABOVE, None)
    return F.when(next_aqi.isNotNull(), label) if strict else label


def class_code(label: Column) -> Column:
    """0, 1, 2 for the three next-hour classes."""
    code = F
    for i, name in enumerate(S.CLASS_NAMES):
        code = code.when(label == name, F.lit(i))
    return code
