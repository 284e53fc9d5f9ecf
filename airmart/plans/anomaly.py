"""PM2.5 anomaly detector: expected value, interval and score per row."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from airmart import schemas as S
from airmart.functions import normal_cdf
from airmart.plans import classify

TOLERANCE = 1e-10  # of a correlation matrix: smaller directions count as dependent
EXACT = 1e-12  # a smaller share of unexplained variance is rounding
ROUNDING = 1e-9  # of a forecast by a model that fits exactly, by size of the reading
INTERVAL = 0.95  # fixed value: share of normal readings inside the bounds
DRIVERS = [*S.CLASSIFIER_WEATHER, *[c for c in S.ANOMALY_AIR if c != "PM2_5"]]


def season(ts: str) -> dict[str, Column]:
    """Daily and yearly cycle of a timestamp."""
    day = F.lit(2 * math.pi / 24) * F.hour(ts)
    year = F.lit(2 * math.pi / 365.25) * F.dayofyear(ts)
    return {
        "DAY_SIN": F.sin(day), "DAY_COS": F.cos(day),
        "YEAR_SIN": F.sin(year), "YEAR_COS": F.cos(year),
    }


def model_terms(drivers: list[str], ts: str, seasons: bool = True) -> dict[str, Column]:
    return {**{c: F.col(c) for c in drivers}, **(season(ts) if seasons else {})}


@dataclass(frozen=True)
class AnomalyModel:
    """A fitted linear expectation; small enough to live in column expressions."""

    ts: str
    target: str
    drivers: list[str]
    coefficients: dict[str, float]
    means: dict[str, float]
    intercept: float
    sigma: float
    seasons: bool = True

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> AnomalyModel:
        return AnomalyModel(**json.loads(text))

    def terms(self) -> dict[str, Column]:
        return model_terms(self.drivers, self.ts, self.seasons)


FITTED = "n long, intercept double, coefficients array<double>, means array<double>, sigma double"


def fit_by_series(
    training: DataFrame,
    series: tuple[str, ...] = (),
    ts: str = "TS",
    target: str = "PM2_5",
    drivers: list[str] = DRIVERS,
    seasons: bool = True,
) -> DataFrame:
    """A linear model of the target for each series: regress it on the drivers and the season.

    One aggregate gathers the co-moments of all terms, so a series of any length is a
    sum of partial sums; every series is then one row whose normal equations are
    solved. The deviation of the residuals follows from the same sums. Terms that are
    constant in a series, or depend on others, get the least coefficients that fit.
    Rows with a missing or undefined term are left out.
    """
    terms = model_terms(drivers, ts, seasons)
    names, label = list(terms), "_label"
    numbers = {label: F.col(target), **terms}
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in numbers])
    rows = training.select(*series, *[c.cast("double").alias(n) for n, c in numbers.items()]).where(usable)
    pairs = [(a, b) for k, a in enumerate(names) for b in names[k:]]
    moments = rows.groupBy(*series).agg(
        F.count("*").alias("n"), F.avg(label).alias("_mean"), F.var_pop(label).alias("_variance"),
        F.array(*[F.avg(c) for c in names]).alias("_means"),
        F.array(*[F.covar_pop(c, label) for c in names]).alias("_with"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("_cross"),
    ).where("n > 0")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*series).schema)
    size, upper = len(names), np.triu_indices(len(names))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: np.array(batch.column(c).to_pylist(), float).reshape(len(batch), -1)  # noqa: B023, E731
            mean, variance, means, with_label = (column(c) for c in ("_mean", "_variance", "_means", "_with"))
            cross = np.zeros((len(batch), size, size))
            cross[:, upper[0], upper[1]] = cross[:, upper[1], upper[0]] = column("_cross")
            scale = np.sqrt(np.diagonal(cross, axis1=1, axis2=2))
            unit = np.where(scale > 0, scale, 1.0)
            # Scaled to correlations, so that one tolerance serves all units.
            inverse = np.linalg.pinv(cross / (unit[:, :, None] * unit[:, None, :]), rcond=TOLERANCE, hermitian=True)
            found = np.einsum("rij,rj->ri", inverse, with_label / unit) / unit
            left = variance[:, 0] - np.einsum("ri,ri->r", found, with_label)
            sigma = np.sqrt(np.where(left > EXACT * variance[:, 0], left, 0.0))
            intercept = mean[:, 0] - np.einsum("ri,ri->r", found, means)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in series], batch.column("n"), pa.array(intercept), pa.array(found.tolist(), pa.list_(pa.float64())), pa.array(means.tolist(), pa.list_(pa.float64())), pa.array(sigma)],
                [*series, "n", "intercept", "coefficients", "means", "sigma"],
            )

    return moments.mapInArrow(solve, f"{types}{', ' if types else ''}{FITTED}")


def fit_anomaly(
    training: DataFrame,
    ts: str = "TS",
    target: str = "PM2_5",
    exclude: tuple[str, ...] = (),
    drivers: list[str] = DRIVERS,
    seasons: bool = True,
) -> AnomalyModel:
    """Unsupervised: one model of the target over all rows; one row of sums reaches the driver."""
    names = [c for c in drivers if c not in exclude]
    fitted = fit_by_series(training, (), ts, target, names, seasons).first()
    if fitted is None:
        raise ValueError("no training row has all readings")
    terms = list(model_terms(names, ts, seasons))
    return AnomalyModel(
        ts, target, names, dict(zip(terms, fitted.coefficients)), dict(zip(terms, fitted.means)),
        fitted.intercept, fitted.sigma, seasons,
    )


def describe(model: AnomalyModel, training: DataFrame) -> dict:
    """What a stored detector must be used with, and what it has seen."""
    return classify.describe(training, model.drivers, [model.target], model.ts)


def load_detector(tables, name: str = "anomaly_model", drivers: list[str] = DRIVERS, target: str = "PM2_5") -> AnomalyModel:
    """The detector of a snapshot or transaction; refused if it was fitted on other readings."""
    classify.require(tables.table(name).facts, features=drivers, labels=[target])
    return AnomalyModel.from_json(tables.read(name).first()[0])


def detect_by_series(
    models: DataFrame, rows: DataFrame, series: tuple[str, ...], ts: str = "TS", target: str = "PM2_5",
    drivers: list[str] = DRIVERS, seasons: bool = True, prediction_interval: float = INTERVAL,
) -> DataFrame:
    """As ``detect_anomalies``, each row by the model of its own series; series without one are skipped."""
    terms = model_terms(drivers, ts, seasons)
    joined = rows.join(models, list(series))
    weights = [(F.col("coefficients")[k], F.col("means")[k], name, c) for k, (name, c) in enumerate(terms.items())]
    forecast = reduce(lambda total, w: total + w[0] * w[3], weights, F.col("intercept"))
    parts = F.struct(*[(w * (c - mean)).alias(name) for w, mean, name, c in weights])
    scored = joined.select(
        *series, F.col(ts).alias("TS"), F.col(target).alias("Y"), forecast.alias("FORECAST"),
        parts.alias("CONTRIBUTIONS"), "sigma",
    )
    return _finished(scored, F.col("sigma"), prediction_interval, series)


def detect_anomalies(
    model: AnomalyModel, rows: DataFrame, prediction_interval: float = INTERVAL,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Forecast, bounds, flag and percentile of each row; unusable rows are skipped.

    ``CONTRIBUTIONS`` says how far each term moves the forecast from its mean.
    """
    terms = model.terms()
    forecast = F.lit(model.intercept)
    for name, column in terms.items():
        forecast = forecast + F.lit(model.coefficients[name]) * column
    parts = F.struct(
        *[
            (F.lit(model.coefficients[name]) * (column - F.lit(model.means[name]))).alias(name)
            for name, column in terms.items()
        ]
    )
    scored = rows.select(
        *keep, F.col(model.ts).alias("TS"), F.col(model.target).alias("Y"),
        forecast.alias("FORECAST"), parts.alias("CONTRIBUTIONS"),
    )
    return _finished(scored, F.lit(model.sigma), prediction_interval, keep)


def _finished(scored: DataFrame, sigma: Column, prediction_interval: float, keep: tuple[str, ...]) -> DataFrame:
    usable = F.col("Y").isNotNull() & F.col("FORECAST").isNotNull() & ~F.isnan("FORECAST")
    return with_score(scored.where(usable), sigma, prediction_interval).select(
        *keep, "TS", "Y", "FORECAST", "LOWER_BOUND", "UPPER_BOUND", "IS_ANOMALY", "PERCENTILE",
        "DISTANCE", "ANOMALY_SCORE", "CONTRIBUTIONS",
    )


def with_score(df: DataFrame, sigma: Column, prediction_interval: float = INTERVAL) -> DataFrame:
    """Bounds and scores from ``Y``, ``FORECAST`` and a residual deviation.

    Where an expectation fits exactly the deviation is 0, and a gap that rounding
    explains counts as none; a larger one is an anomaly without a distance.
    """
    gap = F.col("Y") - F.col("FORECAST")
    rounding = F.when(sigma == 0, F.lit(ROUNDING) * (F.abs("Y") + 1)).otherwise(0.0)
    reach = F.greatest(F.lit(NormalDist().inv_cdf(0.5 + prediction_interval / 2)) * sigma, rounding)
    distance = F.when(sigma > 0, gap / sigma).when(F.abs(gap) <= rounding, F.lit(0.0))
    return (
        df.withColumn("LOWER_BOUND", F.col("FORECAST") - reach)
        .withColumn("UPPER_BOUND", F.col("FORECAST") + reach)
        .withColumn("IS_ANOMALY", F.abs(gap) > reach)
        .withColumn("DISTANCE", distance)
        .withColumn("PERCENTILE", normal_cdf(F.col("DISTANCE")))
        .withColumn("ANOMALY_SCORE", F.col("PERCENTILE"))
    )


def hour_baseline(training: DataFrame, ts: str = "TS", target: str = "PM2_5") -> DataFrame:
    """Mean and deviation of the target per hour of day: at most 24 rows."""
    hours = training.where(F.col(target).isNotNull()).groupBy(F.hour(ts).alias("HOUR_OF_DAY"))
    return hours.agg(F.avg(target).alias("FORECAST"), F.stddev_pop(target).alias("SIGMA"))


def detect_by_hour(
    baseline: DataFrame, rows: DataFrame, ts: str = "TS", target: str = "PM2_5",
    prediction_interval: float = INTERVAL,
) -> DataFrame:
    """Detector with the hour-of-day mean as its forecast; NULL for an hour that training lacks."""
    readings = rows.where(F.col(target).isNotNull()).select(
        F.col(ts).alias("TS"), F.hour(ts).alias("HOUR_OF_DAY"), F.col(target).alias("Y")
    )
    # Grouped by hour of day, the baseline cannot exceed 24 rows.
    joined = readings.join(F.broadcast(baseline), "HOUR_OF_DAY", "left")
    return with_score(joined, F.col("SIGMA"), prediction_interval).drop("SIGMA")
