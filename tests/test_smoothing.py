"""Detectors with memory and by series, against plain loops and least squares."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airmart.plans import anomaly, smoothing
from tests.helpers import at


def readings(spark, rows):
    return spark.createDataFrame([(s, at(h), y) for s, h, y in rows], "station string, TS timestamp_ntz, PM2_5 double")


def plain(rows, a=0.2, g=0.1):
    """Forecasts reading by reading."""
    found, states = {}, {}
    for s, h, y in sorted(rows):
        if s not in states:
            states[s], found[s, at(h)] = (y, [0.0] * 24), None
            continue
        level, season = states[s]
        k = int(h) % 24
        found[s, at(h)] = level + season[k]
        new = a * (y - season[k]) + (1 - a) * level
        season[k] = g * (y - new) + (1 - g) * season[k]
        states[s] = new, season
    return found


@pytest.mark.parametrize("block, group", [(100_000, 1024), (7, 2), (1, 3)])
def test_forecasts_equal_the_plain_loop(spark, block, group):
    rng = random.Random(1)
    rows = [("long", h, rng.uniform(0, 300)) for h in rng.sample(range(2000), 130)]
    rows += [(f"s{k}", h, rng.uniform(0, 300)) for k in range(5) for h in rng.sample(range(400), k * 4)] + [("one", 3, 5.0)]
    df = readings(spark, rows).unionByName(spark.createDataFrame([("long", None, 1.0), ("long", at(5000), None)], "station string, TS timestamp_ntz, PM2_5 double"))
    got = {(r.station, r.TS): r.FORECAST for r in smoothing.smoothed(df.repartition(5), ("station",), rows_per_block=block, maps_per_group=group).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    assert all(w is None and got[k] is None or got[k] == pytest.approx(w, rel=1e-9) for k, w in want.items())


def test_one_series_without_a_key_and_no_rows(spark):
    rows = [("x", h, float(h % 7)) for h in range(50)]
    df = readings(spark, rows).drop("station")
    got = {r.TS: r.FORECAST for r in smoothing.smoothed(df, rows_per_block=9, maps_per_group=2).collect()}
    assert got == {t: pytest.approx(f) if f is not None else None for (_, t), f in plain(rows).items()}
    assert smoothing.detect_smoothed(df).where("abs(FORECAST - Y) <= UPPER_BOUND - FORECAST").count() > 40
    assert smoothing.smoothed(df.limit(0)).count() == 0


def test_a_jump_stands_out(spark):
    rows = [("a", h, 50.0 + 10 * (h % 24 > 12) + (h * 7919 % 13) / 13) for h in range(600)]
    rows[500] = ("a", 500, 200.0)
    found = smoothing.detect_smoothed(readings(spark, rows), ("station",)).where("IS_ANOMALY").orderBy(F.desc("DISTANCE")).first()
    assert found.TS == at(500)


def test_models_of_each_series_are_least_squares(spark):
    rng = np.random.default_rng(2)
    rows = []
    for s, n in (("a", 200), ("b", 40), ("tiny", 2), ("one", 1), ("flat", 30)):
        for k in range(n):
            wind, pressure = (1.0, 1000.0) if s == "flat" else (rng.normal(5, 2), 1e6 + rng.normal(0, 3))
            rows.append((s, at(k), float(3 + 2 * wind - 0.5 * (pressure - 1e6) + rng.normal()), float(wind), float(pressure)))
    rows += [("a", at(900), None, 1.0, 1.0), ("a", at(901), 1.0, float("nan"), 1.0), ("none", at(1), 2.0, None, 1.0)]
    df = spark.createDataFrame(rows, "station string, TS timestamp_ntz, PM2_5 double, WIND_SPEED double, PRESSURE double").repartition(4)
    names = ["WIND_SPEED", "PRESSURE"]
    models = {r.station: r for r in anomaly.fit_by_series(df, ("station",), drivers=names, seasons=False).collect()}
    assert models.keys() == {"a", "b", "tiny", "one", "flat"}
    for s in ("a", "b"):
        own = np.array([r[2:] for r in rows if r[0] == s and r[2] is not None and np.isfinite(r[3])], float)
        x = np.column_stack([np.ones(len(own)), own[:, 1], own[:, 2] - 1e6])
        beta = np.linalg.lstsq(x, own[:, 0], rcond=None)[0]
        assert models[s].coefficients == pytest.approx(beta[1:].tolist(), rel=1e-5)
        assert models[s].sigma == pytest.approx(np.sqrt(((own[:, 0] - x @ beta) ** 2).mean()), rel=1e-5) and models[s].n == len(own)
    assert models["flat"].coefficients == [0, 0] and models["one"].sigma == 0 and models["tiny"].sigma == 0
    found = anomaly.detect_by_series(spark.createDataFrame(models.values()), df, ("station",), drivers=names, seasons=False)
    assert {r.station for r in found.where("IS_ANOMALY").select("station").distinct().collect()} <= {"a", "b", "flat"}
    assert found.where("station = 'none'").count() == 0 and found.where("station in ('one', 'tiny') and DISTANCE = 0").count() == 3


def test_one_pass_over_the_training_rows(spark):
    df = readings(spark, [("a", 1, 1.0)]).withColumn("WIND_SPEED", F.lit(2.0))
    plan = anomaly.fit_by_series(df, ("station",), drivers=["WIND_SPEED"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("partial_covar_pop") > 0
