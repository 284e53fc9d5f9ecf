"""Classifier and detector contracts, with brute-force checks."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from airmart.operators.store import VersionedStore
from airmart.plans import anomaly, classify, datasets, marts
from airmart.sources import sensors


@pytest.fixture(scope="module")
def training(spark, sf01):
    feeds = sensors.hourly_feeds(sensors.read_events(spark, sf01))
    return marts.classifier_training(feeds.weather_history, feeds.air_history).cache()


@pytest.fixture(scope="module")
def model(training):
    return classify.fit_classifier(training)


def test_probabilities(training, model):
    scored = classify.predict(model, training)
    assert scored.columns == [
        "OBSERVATION_TIME", "PREDICTED_CLASS", "PROB_GOOD", "PROB_MODERATE", "PROB_POOR",
    ]
    for r in scored.collect():
        probs = {"Good": r.PROB_GOOD, "Moderate": r.PROB_MODERATE, "Poor": r.PROB_POOR}
        assert sum(probs.values()) == pytest.approx(1.0)
        assert probs[r.PREDICTED_CLASS] == max(probs.values())


def test_skip_and_keep_rows(training, model):
    broken = training.withColumn(
        "US_AQI", F.when(F.hour("OBSERVATION_TIME") < 12, F.col("US_AQI"))
        .otherwise(F.lit(float("nan"))),
    )
    usable = broken.where(classify.usable()).count()
    assert 0 < usable < broken.count()
    assert classify.predict(model, broken).count() == usable
    kept = classify.predict(model, broken, on_error="keep_rows")
    assert kept.count() == broken.count()
    assert kept.where("PREDICTED_CLASS IS NOT NULL AND PROB_GOOD IS NOT NULL").count() == usable
    with pytest.raises(ValueError):
        classify.predict(model, broken, on_error="other")


def test_absent_class_keeps_its_place(training):
    lean = training.where("NEXT_HOUR_CLASS <> 'Good'")
    scored = classify.predict(classify.fit_classifier(lean), lean)
    assert scored.agg(F.max("PROB_GOOD")).first()[0] == 0.0
    assert {r[0] for r in scored.select("PREDICTED_CLASS").distinct().collect()} <= {"Moderate", "Poor"}


def test_label_and_time_are_no_features():
    assert not {"NEXT_HOUR_CLASS", "OBSERVATION_TIME"} & set(classify.FEATURES)


def test_fit_learns_a_separable_label(spark, training):
    """A label that one feature decides must be learned."""
    easy = training.where(classify.usable()).withColumn(
        "NEXT_HOUR_CLASS",
        F.when(F.col("PM2_5") < 2, "Good").when(F.col("PM2_5") < 10, "Moderate").otherwise("Poor"),
    )
    scored = classify.predict(
        classify.fit_classifier(easy), easy, keep=("OBSERVATION_TIME", "NEXT_HOUR_CLASS")
    )
    right = scored.where("PREDICTED_CLASS = NEXT_HOUR_CLASS").count()
    assert right / scored.count() > 0.95


def test_time_split_evaluation(training):
    assert 0.0 <= classify.evaluate_by_time(training, trees=5) <= 1.0


def test_model_round_trip(spark, training, model, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    store.publish_model("classifier_model", model)
    again = PipelineModel.load(store.path("classifier_model"))
    a, b = classify.predict(model, training), classify.predict(again, training)
    assert a.exceptAll(b).count() == 0


@pytest.fixture(scope="module")
def anomaly_rows(spark, sf01):
    feeds = sensors.hourly_feeds(sensors.read_events(spark, sf01))
    return marts.anomaly_rows(feeds.weather_history, feeds.air_history).cache()


@pytest.fixture(scope="module")
def detector(anomaly_rows):
    return anomaly.fit_anomaly(anomaly_rows)


def test_detector_equals_least_squares(anomaly_rows, detector):
    """Brute force: ordinary least squares on the same columns."""
    pdf = anomaly_rows.dropna().toPandas()
    day, year = pdf.TS.dt.hour * 2 * math.pi / 24, pdf.TS.dt.dayofyear * 2 * math.pi / 365.25
    x = np.column_stack(
        [pdf[c] for c in anomaly.DRIVERS] + [np.sin(day), np.cos(day), np.sin(year), np.cos(year)]
    )
    design = np.column_stack([x, np.ones(len(x))])
    weights, *_ = np.linalg.lstsq(design, pdf.PM2_5, rcond=None)
    forecast = design @ weights
    sigma = float(np.sqrt(np.mean((pdf.PM2_5 - forecast) ** 2)))
    assert detector.sigma == pytest.approx(sigma, rel=1e-6)
    got = anomaly.detect_anomalies(detector, anomaly_rows).toPandas().sort_values("TS")
    order = pdf.TS.argsort()
    assert len(got) == len(pdf)
    assert np.allclose(got.FORECAST, forecast[order], atol=1e-5)
    flags = np.abs(pdf.PM2_5 - forecast)[order] > 1.959963984540054 * sigma
    assert (got.IS_ANOMALY.values == flags.values).all()
    assert datasets.anomaly_alerts(anomaly.detect_anomalies(detector, anomaly_rows)).count() == flags.sum()


def test_detector_output_agrees_with_itself(anomaly_rows, detector):
    for r in anomaly.detect_anomalies(detector, anomaly_rows).collect():
        assert r.LOWER_BOUND <= r.FORECAST <= r.UPPER_BOUND
        assert r.ANOMALY_SCORE == r.PERCENTILE
        assert r.IS_ANOMALY == (r.PERCENTILE < 0.025 or r.PERCENTILE > 0.975)
        mean_forecast = detector.intercept + sum(
            detector.coefficients[k] * m for k, m in detector.means.items()
        )
        assert mean_forecast + sum(r.CONTRIBUTIONS) == pytest.approx(r.FORECAST, abs=1e-6)


def test_detector_skips_unusable_rows_and_can_leave_drivers_out(anomaly_rows, detector):
    complete = anomaly_rows.dropna(subset=anomaly.DRIVERS).count()
    assert complete < anomaly_rows.count()
    assert anomaly.detect_anomalies(detector, anomaly_rows).count() == complete
    lean = anomaly.fit_anomaly(anomaly_rows, exclude=("US_AQI", "PM10"))
    without_aqi = [c for c in anomaly.DRIVERS if c not in ("US_AQI", "PM10")]
    expected = anomaly_rows.dropna(subset=without_aqi).count()
    assert complete < expected
    assert anomaly.detect_anomalies(lean, anomaly_rows).count() == expected


def test_wider_interval_flags_fewer(anomaly_rows, detector):
    def flagged(interval):
        found = anomaly.detect_anomalies(detector, anomaly_rows, interval)
        return datasets.anomaly_alerts(found).count()

    assert flagged(0.999) < flagged(0.95) < flagged(0.5)


def test_detector_round_trip(detector):
    assert anomaly.AnomalyModel.from_json(detector.to_json()) == detector
