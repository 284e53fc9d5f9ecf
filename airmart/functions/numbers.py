"""Numeric coercion and the normal distribution."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Published rational approximation of the error function,
# 1 - (a1 t + ... + a5 t^5) exp(-x^2) with t = 1 / (1 + p x).
_ERF_P = 0.3275911
_ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def nullable_double(value: Column) -> Column:
    """Number or NULL; NaN and text that is no number both become NULL."""
    return F.nullif(value.try_cast("double"), F.lit(float("nan")))


def nullable_int(value: Column) -> Column:
    # Through double first: "1.0" and NaN are both legal inputs.
    return nullable_double(value).try_cast("int")


def strict_cast(value: Column, type_name: str, name: str) -> Column:
    """Cast that fails the job on a missing or malformed value."""
    number = value.cast("double")
    missing = number.isNull() | F.isnan(number)
    problem = F.raise_error(F.lit(f"{name} is missing")).cast(type_name)
    return F.when(missing, problem).otherwise(number.cast(type_name))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, absolute error below 1e-7."""
    x = F.abs(z) / F.lit(2.0 ** 0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_ERF_P) * x)
    poly = F.lit(0.0)
    for a in reversed(_ERF_A):
        poly = (poly + F.lit(a)) * t
    erf = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(z >= 0, (F.lit(1.0) + erf) / 2).otherwise((F.lit(1.0) - erf) / 2)
