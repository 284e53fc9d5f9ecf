"""Queries of whole runs: stores, deliveries, gates, catalogs, stored models, streams with late rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from airmart import schemas as S
from airmart.functions import class_code
from airmart.operators import quality
from airmart.operators.coerce import conform
from airmart.operators.dedup import unite
from airmart.operators.store import StoreConflict, VersionedStore
from airmart.plans import anomaly, classify, datasets, marts, smoothing
from airmart.plans.refresh import HISTORY_TABLES, Options, Refresh
from airmart.session import materialize, scratch_path
from airmart.sources import payload, sensors
from airmart.streaming import hourly as streams
from workload import queries as Q

STATION = Q.STATION
NAMES = {"weather": "TEMPERATURE", "airquality": "PM10"}


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def count_row(rows: DataFrame, **tags: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("N_ROWS")).select(*[F.lit(v).alias(k) for k, v in tags.items()], "N_ROWS")


# -- landings --------------------------------------------------------------


def _tables(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], datetime]:
    events = sensors.read_events(spark, sf_dir)
    now = spark.range(1).select(sensors.load_time(events)).first()[0]
    return {"weather": sensors.station_weather(events), "airquality": sensors.station_air(events)}, now


def _land_history(rows: DataFrame, root: str, kind: str) -> None:
    """A file for each day of ``rows``, beside those that are there."""
    day = F.to_date(S.TIME).alias(payload.LANDING_DATE)
    lines = payload.to_payload(rows, kind, [F.col(sensors.STATION), day])
    lines.repartition(payload.LANDING_DATE).write.partitionBy(payload.LANDING_DATE).mode("append").json(f"{root}/{kind}_history")


def _land_now(rows: DataFrame, root: str, kind: str, now: datetime) -> None:
    """The running day of every station, as a realtime load gets it."""
    today = rows.where(F.to_date(S.TIME) == F.lit(now.date()))
    payload.to_payload(today, kind, [F.col(sensors.STATION)]).write.mode("append").json(f"{root}/{kind}_realtime")


def store_incremental_days(spark, sf_dir):
    """Classifier rows after three uneven deliveries, each of which writes only the days it changes.

    First the older half of the days, with wrong temperatures at every third station;
    then the newer half; then the right temperatures.
    """
    tables, now = _tables(spark, sf_dir)
    root = scratch_path(spark, "landing")
    run = Refresh(spark, root, scratch_path(spark, "store"), now, Options(series=STATION))
    first, last = tables["weather"].agg(F.min(S.TIME), F.max(S.TIME)).first()
    older = F.to_date(S.TIME) < F.lit((first + (last - first) / 2).date())
    third = F.col(sensors.STATION).cast("long") % 3 == 0
    for delivery in ("older", "newer", "corrected"):
        for kind, table in tables.items():
            wrong = table.withColumn(NAMES[kind], F.when(third, F.lit(-1.0)).otherwise(F.col(NAMES[kind])))
            rows = {"older": wrong.where(older), "newer": table.where(~older), "corrected": table.where(older & third)}
            _land_history(rows[delivery], root, kind)
            run.load_history(kind)
        run.build_history()
    return Q.rounded(run.store.read("classifier_training"), "PM25_ROLL24")


def catalog_views(spark, sf_dir):
    """Raw pair, staging and marts read by their names, after three runs and a prune."""
    tables, now = _tables(spark, sf_dir)
    root, prefix = scratch_path(spark, "landing"), f"t{uuid.uuid4().hex[:8]}_"
    store = scratch_path(spark, "store")
    for days in (2, 1, 0):
        instant = now - timedelta(days=days)
        run = Refresh(spark, root, store, instant, Options(series=STATION, retention=timedelta(0)))
        since = F.to_date(S.TIME) >= F.lit((instant - timedelta(days=1)).date())
        for kind, table in tables.items():
            _land_history(table if days == 2 else table.where(since), root, kind)
            _land_now(table, root, kind, instant)
            run.load_history(kind)
        run.load_realtime()
        run.release()
        names = run.publish_views(prefix)
        run.prune()
    found = []
    for name in names:
        rows = spark.table(name)
        measure = next(c for c in ("TEMPERATURE", "PM2_5") if c in rows.columns)
        total = rows.agg(F.count("*").alias("N_ROWS"), F.sum(measure).alias("TOTAL"))
        found.append(total.select(F.lit(name.removeprefix(prefix)).alias("NAME"), "N_ROWS", "TOTAL"))
    result = materialize(Q.rounded(union(found), "TOTAL"), "catalog")
    for layer in {name.split(".")[0] for name in names}:
        spark.sql(f"DROP DATABASE {layer} CASCADE")
    return result


def dq_gate(spark, sf_dir):
    """What readers see of the fact table after clean, refused and mended runs."""
    f = Q._stations(spark, sf_dir)
    root = scratch_path(spark, "store")
    # Written once: hours are aggregated from events once and not in each of the runs.
    tables = {name: materialize(rows, name) for name, rows in {
        "raw_weather_history": f.weather_history, "raw_airquality_history": f.air_history,
        "raw_weather_realtime": f.weather_now, "raw_airquality_realtime": f.air_now,
    }.items()}
    history = tables["raw_weather_history"]
    repeated = history.where(F.hour(S.TIME) == 0)
    steps = []
    for step, dedup, weather in (
        ("clean", "as_written", history),
        ("refused", "as_written", history.unionByName(repeated)),
        ("mended", "unified", history.unionByName(repeated)),
    ):
        run = Refresh(spark, "", root, datetime(2024, 1, 1), Options(series=STATION, dedup=dedup))
        run.store.refresh_together(tables | {"raw_weather_history": weather})
        try:
            run.release()
            released = True
        except quality.QualityError:
            released = False
        seen = count_row(run.store.read("fact_hourly"), STEP=step)
        checks = quality.check_keys("stg_weather", unite(*run.raw("weather"), dedup, STATION), STATION)
        failures = checks.agg(F.sum("failures").alias("FAILURES")).scalar()
        steps.append(seen.select("STEP", F.lit(released).alias("RELEASED"), "N_ROWS", failures.alias("FAILURES")))
    return materialize(union(steps), "gate")


# -- writers ---------------------------------------------------------------


def store_two_writers(spark, sf_dir):
    """Writers that overlap: on one table the second is refused, on another both commit."""
    f = Q._stations(spark, sf_dir)
    store = VersionedStore(spark, scratch_path(spark, "store"))
    store.refresh("raw_weather_history", f.weather_history.limit(0))
    outcomes = []

    def overlapping(name: str, table: str, rows: DataFrame, inner: Callable[[], None]) -> None:
        try:
            with store.transaction() as own:
                own.write(table, rows)
                inner()
            outcomes.append((name, "committed"))
        except StoreConflict:
            outcomes.append((name, "refused"))

    def first() -> None:
        store.refresh("raw_weather_history", f.weather_history)
        outcomes.append(("first", "committed"))

    overlapping("second", "raw_weather_history", f.weather_now, first)
    overlapping("third", "raw_airquality_history", f.air_history, lambda: store.refresh("other", f.air_now))
    told = spark.createDataFrame([(*o, -1) for o in outcomes], "NAME string, OUTCOME string, N_ROWS long")
    tables = [
        count_row(store.read(t), NAME=t, OUTCOME="readable")
        for t in ("raw_weather_history", "raw_airquality_history", "other")
    ]
    return union([told, *tables])


def store_failed_refresh(spark, sf_dir):
    """Air-quality history after refreshes that fail half way, lose to a reader, or bring nothing."""
    f = Q._stations(spark, sf_dir)
    store = VersionedStore(spark, scratch_path(spark, "store"))
    store.refresh_if_nonempty("raw_airquality_history", f.air_history)
    broken = f.air_history.withColumn(
        "DUST", F.when(F.hour(S.TIME) == 7, F.raise_error(F.lit("broken input")).cast("double")).otherwise(F.col("DUST"))
    )
    try:
        store.refresh_if_nonempty("raw_airquality_history", broken)
    except Exception as error:  # noqa: BLE001
        if "broken input" not in str(error):
            raise
    store.refresh_if_nonempty("raw_airquality_history", f.air_history.where("OBSERVATION_TIME IS NULL"))
    return store.read("raw_airquality_history")


# -- checks ----------------------------------------------------------------


def current_hour_absent(spark, sf_dir):
    """Stations that have no row for the running hour, of each feed."""
    events = sensors.read_events(spark, sf_dir)
    now = sensors.load_time(events)
    tables = {"weather": sensors.station_weather(events), "airquality": sensors.station_air(events)}
    return union([
        quality.absent_hours(table, now, STATION).withColumn("FEED", F.lit(kind)) for kind, table in tables.items()
    ])


def dq_not_null_keys(spark, sf_dir):
    """Key checks of staging where some times cannot be read and some stations are unknown."""
    events = sensors.read_events(spark, sf_dir)
    broken = F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
    parts = []
    for kind in S.FIELDS:
        text = F.substring(F.col("ts").cast("string"), 1, 13)
        fields = [
            F.coalesce(broken, F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit(":00"))).alias(field)
            if field == "time" else F.col("value").alias(field)
            for field in S.FIELDS[kind]
        ]
        station = F.when(F.col("event_id") % 89 != 0, F.col("user_id").cast("string")).alias(sensors.STATION)
        rows = conform(events.select(station, *fields), kind, STATION, unknown_times=True)
        parts.append(quality.check_keys(f"stg_{kind}", rows, STATION))
        nulls = quality.null_rows(rows, S.TIME).agg(F.count("*").alias("failures"))
        parts.append(nulls.select(F.lit(f"stg_{kind}").alias("model"), F.lit("time").alias("check"), "failures"))
    return union(parts)


def clf_training_time_frames(spark, sf_dir):
    """Classifier rows whose lags, averages and next hours go by the clock."""
    feeds = Q._stations(spark, sf_dir)
    mart = marts.classifier_training(
        feeds.weather_history, feeds.air_history, STATION, time_based=True, rows_per_block=500
    )
    return Q.rounded(mart, "PM25_ROLL24")


# -- models ----------------------------------------------------------------

BANDS = (20.0, 60.0)
BAND = ["BAND"]
DETECTED = ["Y", "FORECAST", "LOWER_BOUND", "UPPER_BOUND", "IS_ANOMALY", "DISTANCE", "PERCENTILE"]
ROUNDED = ["FORECAST", "LOWER_BOUND", "UPPER_BOUND", "DISTANCE", "PERCENTILE"]


def banded(rows: DataFrame) -> DataFrame:
    """A feature that tells the class exactly, so that what a forest must answer is known."""
    p = F.col("PM2_5")
    band = F.when(p <= BANDS[0], S.CLASS_NAMES[0]).when(p <= BANDS[1], S.CLASS_NAMES[1]).when(p.isNotNull(), S.CLASS_NAMES[2])
    return rows.withColumn("NEXT_HOUR_CLASS", band).withColumn("BAND", class_code(band).cast("double"))


def _banded(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Training rows, written, and rows to score."""
    feeds = Q._stations(spark, sf_dir)
    training = marts.classifier_training(feeds.weather_history, feeds.air_history, STATION)
    rows = marts.classifier_inference(feeds.weather_history, feeds.air_history, feeds.weather_now, feeds.air_now, STATION)
    return materialize(banded(training), "training"), banded(rows)


def _scored(model, rows: DataFrame) -> DataFrame:
    return Q.rounded(classify.predict(model, rows, keep=Q.KEYS, features=BAND), "PROB_GOOD", "PROB_MODERATE", "PROB_POOR")


def clf_predict_exact(spark, sf_dir):
    training, rows = _banded(spark, sf_dir)
    return _scored(classify.fit_classifier(training, features=BAND), rows)


def clf_backcast_exact(spark, sf_dir):
    training, _ = _banded(spark, sf_dir)
    return _scored(classify.fit_classifier(training, features=BAND), training)


def ds_predictions_exact(spark, sf_dir):
    training, rows = _banded(spark, sf_dir)
    model = classify.fit_classifier(training, features=BAND)
    return datasets.class_predictions(_scored(model, rows), _scored(model, training))


def clf_predict_stored(spark, sf_dir):
    """Rows scored by a model that an earlier run stored; nothing is fitted, and other features are refused."""
    training, rows = _banded(spark, sf_dir)
    store = VersionedStore(spark, scratch_path(spark, "store"))
    model = classify.fit_classifier(training, features=BAND)
    store.publish_model("classifier_model", model, classify.describe(training, BAND))
    later = VersionedStore(spark, store.root).snapshot()
    try:
        classify.load_classifier(later)
        refused = False
    except classify.ModelMismatch:
        refused = True
    found = _scored(classify.load_classifier(later, features=BAND), rows)
    return found.withColumn("OTHERS_REFUSED", F.lit(refused))


WIND = ["WIND_SPEED"]


def _detector_rows(spark, sf_dir) -> DataFrame:
    feeds = Q._stations(spark, sf_dir)
    return materialize(marts.anomaly_rows(feeds.weather_history, feeds.air_history, STATION), "training")


def _shown(found: DataFrame) -> DataFrame:
    part = F.col("CONTRIBUTIONS.WIND_SPEED").alias("WIND_PART")
    return Q.rounded(found.select(*STATION, "TS", *DETECTED, part), *ROUNDED, "WIND_PART")


def anomaly_detect_one_driver(spark, sf_dir):
    """One model of all rows on one driver, whose values SQL knows as well."""
    rows = _detector_rows(spark, sf_dir)
    model = anomaly.fit_anomaly(rows, drivers=WIND, seasons=False)
    return _shown(anomaly.detect_anomalies(model, rows, keep=STATION))


def ds_alerts_one_driver(spark, sf_dir):
    rows = _detector_rows(spark, sf_dir)
    model = anomaly.fit_anomaly(rows, drivers=WIND, seasons=False)
    return _shown(datasets.anomaly_alerts(anomaly.detect_anomalies(model, rows, keep=STATION)))


def anomaly_detect_stored(spark, sf_dir):
    """Rows scored by the detector that an earlier run stored."""
    rows = _detector_rows(spark, sf_dir)
    store = VersionedStore(spark, scratch_path(spark, "store"))
    model = anomaly.fit_anomaly(rows, drivers=WIND, seasons=False)
    with store.transaction() as own:
        fitted = spark.range(1).select(F.lit(model.to_json()).alias("model"))
        own.write("anomaly_model", fitted, anomaly.describe(model, rows))
    later = VersionedStore(spark, store.root).snapshot()
    try:
        anomaly.load_detector(later)
        refused = False
    except classify.ModelMismatch:
        refused = True
    loaded = anomaly.load_detector(later, drivers=WIND)
    return _shown(anomaly.detect_anomalies(loaded, rows, keep=STATION)).withColumn("OTHERS_REFUSED", F.lit(refused))


def anomaly_detect_by_station(spark, sf_dir):
    """A model for each station, solved from one aggregate of co-moments."""
    rows = _detector_rows(spark, sf_dir)
    models = anomaly.fit_by_series(rows, STATION, drivers=WIND, seasons=False)
    return _shown(anomaly.detect_by_series(models, rows, STATION, drivers=WIND, seasons=False))


def anomaly_smoothed(spark, sf_dir):
    """Exponential smoothing of level and season, in blocks that cut through the stations."""
    rows = _detector_rows(spark, sf_dir)
    found = smoothing.detect_smoothed(rows, STATION, rows_per_block=500, maps_per_group=4)
    return Q.rounded(found.select(*STATION, "TS", *DETECTED), *ROUNDED)


# -- streams ---------------------------------------------------------------

DELIVERIES = 4


def stream_late_rows(spark, sf_dir):
    """Four deliveries, in part late or repeated: what became of every row, and the hours both feeds have.

    Days go to the deliveries in order, but those of every fifth station in the first come
    with the third, and those of every third station in the second come again with it.
    """
    tables, _ = _tables(spark, sf_dir)
    root, out = scratch_path(spark, "landing"), scratch_path(spark, "fates")
    checkpoint = scratch_path(spark, "checkpoint")
    first, last = tables["weather"].agg(F.min(S.TIME), F.max(S.TIME)).first()
    days = (last.date() - first.date()).days + 1
    place = F.floor(F.datediff(F.to_date(S.TIME), F.lit(first.date())) * DELIVERIES / days)
    station = F.col(sensors.STATION).cast("long")
    slow, again = (station % 5 == 0) & (place == 0), (station % 3 == 1) & (place == 1)
    session = Q._stream_session(spark)
    for number in range(DELIVERIES):
        for kind, table in tables.items():
            here = (place == number) & ~slow
            if number == 2:
                here = here | slow | again
            day = F.to_date(S.TIME).alias("obs_date")
            lines = payload.to_payload(table.where(here), kind, [F.col(sensors.STATION), day]).drop("obs_date")
            lines.write.mode("append").json(f"{root}/{kind}")
        feeds = (streams.payload_stream(session, f"{root}/{kind}", kind, STATION) for kind in S.FIELDS)
        judged = streams.delivery_fates(streams.tagged_pair(*feeds), "2 days", STATION)
        streams.write_fates(judged, out, checkpoint).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(judged.schema).parquet(out)
    counts = streams.fate_counts(found)
    kept = found.where(F.col(streams.FATE) == streams.ACCEPTED)
    pairs = kept.groupBy(sensors.STATION, S.TIME).agg(F.count_distinct(streams.FEED).alias("n"))
    joined = pairs.agg(F.count_if(F.col("n") == 2).alias("JOINED")).scalar()
    return counts.withColumn("JOINED", joined)


def all_queries() -> dict[str, Q.Query]:
    return {q.__name__: q for q in (
        store_incremental_days, catalog_views, dq_gate, store_two_writers, store_failed_refresh,
        current_hour_absent, dq_not_null_keys, clf_training_time_frames, clf_predict_exact,
        clf_backcast_exact, ds_predictions_exact, clf_predict_stored, anomaly_detect_one_driver,
        ds_alerts_one_driver, anomaly_detect_stored, anomaly_detect_by_station, anomaly_smoothed,
        stream_late_rows,
    )}
