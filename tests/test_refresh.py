"""A whole hourly run from landed files."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from airmart import schemas as S
from airmart.operators.quality import QualityError
from airmart.plans import anomaly, classify, marts
from airmart.plans.refresh import Options, Refresh
from airmart.streaming.hourly import REALTIME_TABLES
from tests.helpers import at

HOURS = 24 * 12
NOW = at(HOURS + 0.5)


def payload(kind, hours):
    hourly = {"time": [at(h).strftime("%Y-%m-%dT%H:%M") for h in hours]}
    for i, field in enumerate(f for f in S.FIELDS[kind] if f != "time"):
        hourly[field] = [float((h * (7 + i)) % 97 + (h * h) % 13) for h in hours]
    if kind == "weather":
        hourly["is_day"] = [int(6 <= h % 24 < 18) for h in hours]
    else:
        hourly["us_aqi"] = [float((h * 29) % 160) for h in hours]
    return json.dumps({"hourly": hourly})


def land(root):
    for kind in S.FIELDS:
        for day in range(HOURS // 24 + 1):
            folder = root / f"{kind}_history" / f"obs_date={(at(0) + timedelta(days=day)).date()}"
            folder.mkdir(parents=True)
            (folder / "a.json").write_text(payload(kind, range(day * 24, day * 24 + 24)))
        folder = root / f"{kind}_realtime"
        folder.mkdir()
        (folder / "a.json").write_text(payload(kind, range(HOURS, HOURS + 24)))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    land(root / "landing")
    run = Refresh(spark, str(root / "landing"), str(root / "store"), NOW)
    run.run()
    return run


def test_raw_tables(run):
    for kind in S.FIELDS:
        history, now = run.raw(kind)
        assert history.count() == HOURS  # the running hour is realtime, not history
        assert [r.OBSERVATION_TIME for r in now.collect()] == [at(HOURS)]


def test_history_files_keep_days_apart(run):
    history = run.store.read("raw_weather_history")
    assert "obs_date" not in history.columns and history.schema == S.table_schema("weather")
    assert all("obs_date=" in f for f in history.inputFiles())
    days = history.select(
        F.input_file_name().alias("f"), F.to_date(S.TIME).alias("d")
    ).distinct().groupBy("f").count()
    assert days.agg(F.max("count")).first()[0] == 1


def test_all_tables_exist(run):
    sizes = {
        "fact_hourly": HOURS + 1, "classifier_training": HOURS - 2, "classifier_inference": 1,
        "anomaly_training": HOURS, "anomaly_inference": 1, "final_prediction_clean": 1,
        "final_prediction_historical": HOURS - 2, "realtime_anomaly_preds": 1,
        "ds_aqi_daily": HOURS // 24 + 1, "ds_heatmap": 7 * 24, "ds_history_vs_now": 1,
        "ds_wind_trend": 1, "ds_predictions": HOURS - 1,
    }
    assert {name: run.store.read(name).count() for name in sizes} == sizes
    assert run.spark.table("stg_weather").count() == HOURS + 1


def test_staging_as_views_gives_the_same_fact(spark, run):
    before = run.store.read("fact_hourly")
    views = Refresh(spark, run.landing, run.store.root, NOW, Options(staging="view"))
    views.build()
    views.check()
    after = run.store.read("fact_hourly")
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_catalog_views_follow_the_newest_version(spark, run):
    names = run.publish_views()
    assert "raw.raw_weather_realtime" in names and "analytics.fact_hourly" in names
    assert spark.table("raw.raw_weather_history").count() == HOURS
    fact = spark.sql("SELECT count(*) FROM analytics.fact_hourly WHERE TEMP_CATEGORY = 'Normal'")
    assert 0 < fact.first()[0] <= HOURS + 1
    run.store.refresh("anomaly_inference", run.store.read("anomaly_inference").limit(0))
    assert spark.table("analytics.anomaly_inference").count() == 0
    run.build()
    for database in ("raw", "staging", "analytics"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_prune_keeps_what_was_superseded_a_moment_ago(run):
    run.build()
    kept = run.store.commits()
    run.prune()
    assert run.store.commits() == kept
    run.store.prune()
    assert run.store.commits() == kept[-1:] and run.store.read("fact_hourly").count() == HOURS + 1


def test_prediction_is_for_the_current_hour(run):
    row = run.store.read("final_prediction_clean").first()
    assert row.OBSERVATION_TIME == at(HOURS) and row.PREDICTED_CLASS in S.CLASS_NAMES


def test_rerun_gives_the_same_tables(run):
    before = run.store.read("classifier_training")
    run.load_history("weather")
    run.load_history("airquality")
    run.load_realtime()
    run.build()
    after = run.store.read("classifier_training")
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_absent_hour_empties_realtime_only(spark, run, caplog):
    later = Refresh(spark, run.landing, run.store.root, at(HOURS + 40))
    assert set(later.load_realtime().values()) == {0}
    assert "no row for the hour" in caplog.text
    assert later.raw("weather")[0].count() == HOURS
    later.build()
    assert later.store.read("classifier_inference").first().OBSERVATION_TIME == at(HOURS - 1)
    run.load_realtime()
    run.build()


def test_gate_stops_before_the_models(spark, run, tmp_path):
    """As-written staging lets repeated history rows through; the gate must see them."""
    broken = Refresh(spark, run.landing, str(tmp_path), NOW, Options(dedup="as_written"))
    for table in ("raw_weather_history", "raw_airquality_history"):
        history = run.store.read(table)
        broken.store.refresh(table, history.unionByName(history.limit(1)))
    broken.load_realtime()
    broken.load_history = lambda kind: 0
    with pytest.raises(QualityError):
        broken.run()
    assert not broken.store.exists("anomaly_model") and not broken.store.exists("classifier_model")
    # Nobody sees what the gate refused; what was loaded stays loaded.
    assert not broken.store.exists("fact_hourly") and not broken.store.exists("stg_weather")
    assert all(broken.store.exists(t) for t in REALTIME_TABLES.values())


def test_scoring_needs_no_training(spark, run, monkeypatch):
    monkeypatch.setattr(classify, "fit_classifier", None)
    monkeypatch.setattr(anomaly, "fit_anomaly", None)
    later = Refresh(spark, run.landing, run.store.root, NOW)
    before = run.store.read("final_prediction_clean").collect()
    later.score_classes()
    later.score_anomalies()
    assert run.store.read("final_prediction_clean").collect() == before
    facts = run.store.snapshot().table("classifier_model").facts
    assert facts["rows"] == HOURS - 2 and facts["features"] == classify.FEATURES and facts["first"] < facts["last"]
    with pytest.raises(classify.ModelMismatch):
        classify.load_classifier(run.store.snapshot(), features=classify.FEATURES[::-1])
    with pytest.raises(classify.ModelMismatch):
        anomaly.load_detector(run.store.snapshot(), drivers=["PM10"])


def test_strict_realtime_weather(spark, tmp_path):
    for kind in S.FIELDS:
        (tmp_path / f"{kind}_realtime").mkdir()
        hourly = json.loads(payload(kind, range(HOURS, HOURS + 2)))
        key = "rain" if kind == "weather" else "dust"
        hourly["hourly"][key] = [None, 1.0]
        (tmp_path / f"{kind}_realtime" / "a.json").write_text(json.dumps(hourly))
    args = (spark, str(tmp_path), str(tmp_path / "store"), NOW)
    assert Refresh(*args).load_realtime() == {"raw_weather_realtime": 1, "raw_airquality_realtime": 1}
    with pytest.raises(Exception, match="RAIN is missing"):
        Refresh(*args, Options(strict_realtime=True)).load_realtime()


def test_run_by_station_in_blocks(spark, tmp_path):
    """Two stations in one landing; keys, windows, models and datasets all go by station."""
    days = 4
    for kind in S.FIELDS:
        for part, hours in (("history", range(24 * days)), ("realtime", range(24 * days, 24 * days + 2))):
            folder = tmp_path / "landing" / f"{kind}_{part}"
            if part == "history":
                folder = folder / f"obs_date={at(0).date()}"
            folder.mkdir(parents=True)
            lines = [
                json.dumps({"station": name, **json.loads(payload(kind, [h + shift for h in hours]))})
                for name, shift in (("a", 0), ("b", -1))
            ]
            (folder / "all.json").write_text("\n".join(lines))
    options = Options(series=("station",), strategy="blocked")
    run = Refresh(spark, str(tmp_path / "landing"), str(tmp_path / "store"), at(24 * days + 0.5), options)
    run.run()
    hours = 24 * days
    sizes = {
        # b starts an hour earlier and its last history hour is an hour older
        "fact_hourly": 2 * hours + 2, "anomaly_training": 2 * hours,
        "classifier_training": 2 * (hours - 2), "classifier_inference": 2,
        "final_prediction_clean": 2, "realtime_anomaly_preds": 2, "ds_history_vs_now": 2,
    }
    assert {name: run.store.read(name).count() for name in sizes} == sizes
    training = run.store.read("classifier_training")
    assert {r.station: r.n for r in training.groupBy("station").agg(F.count("*").alias("n")).collect()} == {
        "a": hours - 2, "b": hours - 2,
    }
    plain = marts.classifier_rows(
        run.store.read("anomaly_training").withColumnRenamed("TS", S.TIME).drop("PM10"),
        ("station",), "series",
    )
    rounded = [d.withColumn("PM25_ROLL24", F.round("PM25_ROLL24", 6)) for d in (training, plain)]
    assert rounded[0].exceptAll(rounded[1]).count() == 0
