"""One DataFrame query per operator, over whole tables.

Averages and other sums of doubles are rounded to six digits: their last bits
depend on the order of addition, here and in any other engine. Two-digit inputs
make averages that lie exactly between two such roundings, hence the nudge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from airmart import schemas as S
from airmart.functions import class_code, iso_text, trunc_hour
from airmart.operators import quality
from airmart.operators.coerce import before_cutoff, conform, current_hour
from airmart.operators.dedup import unite
from airmart.operators.latest import latest_rows, newest_per_hour
from airmart.operators.store import VersionedStore
from airmart.plans import anomaly, classify, datasets, marts
from airmart.session import ROCKSDB_STATE, materialize, scratch_path
from airmart.sources import payload, sensors
from airmart.streaming import hourly as streams

STATION = (sensors.STATION,)
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + F.lit(1e-9), 6) for c in columns})


# -- ingest ----------------------------------------------------------------


def _wire_rows(events: DataFrame, complete: bool) -> DataFrame:
    """Events under payload names: minute text, NaN where a type has no sensor."""
    holes = {"temperature_2m": "error", "relative_humidity_2m": "signup", "is_day": "click"}
    columns = [iso_text(F.col("ts"), seconds=False).alias("time")]
    for field in list(S.WEATHER_FIELDS)[1:]:
        value = F.col("value")
        if field == "is_day":
            value = F.hour("ts").between(6, 17).cast("double")
        if field in holes and not complete:
            value = F.when(F.col("event_type") == holes[field], F.lit(float("nan"))).otherwise(value)
        columns.append(value.alias(field))
    return events.select("event_id", *columns)


def ingest_rename_cast(spark, sf_dir):
    rows = _wire_rows(sensors.read_events(spark, sf_dir), complete=False)
    return conform(rows, "weather", ("event_id",))


def ingest_strict(spark, sf_dir):
    rows = _wire_rows(sensors.read_events(spark, sf_dir), complete=True)
    return conform(rows, "weather", ("event_id",), strict=True)


def json_props_extract(spark, sf_dir):
    """Whole row as an open object, then typed paths out of it."""
    events = sensors.read_events(spark, sf_dir)
    row = F.to_variant_object(F.struct("event_type", "value"))
    opened = events.select("event_id", F.parse_json("props").alias("p"), row.alias("o"))
    return opened.select(
        "event_id",
        F.variant_get("p", "$.k", "bigint").alias("K"),
        F.variant_get("p", "$.k", "string").alias("K_TEXT"),
        F.variant_get("o", "$.event_type", "string").alias("KIND"),
        F.variant_get("o", "$.value", "double").alias("AMOUNT"),
    )


def _station_payload(table: DataFrame, kind: str) -> DataFrame:
    """One payload per station and day: 24 entries at most."""
    day = F.to_date(S.TIME).alias("obs_date")
    return payload.to_payload(table, kind, [F.col(sensors.STATION), day])


def hourly_payload_inline(spark, sf_dir):
    weather = sensors.station_weather(sensors.read_events(spark, sf_dir))
    wire = _station_payload(weather, "weather").select(
        F.to_json(F.struct(sensors.STATION, "hourly")).alias("line")
    )
    schema = S.payload_schema("weather", STATION)
    parsed = wire.select(F.from_json("line", schema).alias("o")).select("o.*")
    return payload.hourly_table(parsed, "weather", STATION)


def landing_range(spark, sf_dir):
    """Rows each history load asks for half an hour past midnight."""
    events = sensors.read_events(spark, sf_dir)
    midnight = events.agg(F.to_date(F.max("ts")).cast("timestamp_ntz").alias("m")).scalar()
    now = midnight + F.expr("INTERVAL 30 MINUTES")
    dated = events.withColumn("OBS_DATE", F.to_date("ts"))
    parts = [
        dated.where(payload.in_request_range(F.col("OBS_DATE"), now, kind))
        .groupBy(F.lit(kind).alias("KIND"), "OBS_DATE")
        .agg(F.count(F.lit(1)).alias("N_ROWS"))
        for kind in S.FIELDS
    ]
    return parts[0].unionByName(parts[1])


def history_cutoff(spark, sf_dir):
    events = sensors.read_events(spark, sf_dir)
    return before_cutoff(sensors.event_weather(events), sensors.load_time(events))


def current_hour_weather(spark, sf_dir):
    events = sensors.read_events(spark, sf_dir)
    return current_hour(sensors.station_weather(events), sensors.load_time(events), STATION)


def current_hour_airquality(spark, sf_dir):
    events = sensors.read_events(spark, sf_dir)
    return current_hour(sensors.station_air(events), sensors.load_time(events), STATION)


# -- staging ---------------------------------------------------------------


def _repeated(spark, sf_dir, kind: str) -> tuple[DataFrame, DataFrame]:
    """Every event as a row of its hour, so keys repeat; realtime repeats the last hour."""
    events = sensors.read_events(spark, sf_dir)
    # The second measure identifies the event, the others share its value.
    measures = list(S.FIELDS[kind].values())[1:]
    columns = [
        (F.col("event_id").cast("double") if i == 1 else F.col("value"))
        .cast(S.column_type(name)).alias(name)
        for i, name in enumerate(measures)
    ]
    rows = events.select(trunc_hour(F.col("ts")).alias(S.TIME), *columns)
    latest = events.agg(trunc_hour(F.max("ts")).alias("c")).scalar()
    return rows, rows.where(F.col(S.TIME) == latest)


def _staging(kind: str, dedup: str) -> Query:
    return lambda spark, sf_dir: unite(*_repeated(spark, sf_dir, kind), dedup)


def _station_stage(feeds: sensors.Feeds, series=STATION) -> tuple[DataFrame, DataFrame]:
    return (
        unite(feeds.weather_history, feeds.weather_now, series=series),
        unite(feeds.air_history, feeds.air_now, series=series),
    )


# -- marts -----------------------------------------------------------------


def _hourly(spark, sf_dir) -> sensors.Feeds:
    return sensors.hourly_feeds(sensors.read_events(spark, sf_dir))


def _stations(spark, sf_dir) -> sensors.Feeds:
    return sensors.station_feeds(sensors.read_events(spark, sf_dir))


def fact_hourly(spark, sf_dir):
    return marts.fact_hourly(*_station_stage(_hourly(spark, sf_dir), ()))


def fact_by_station(spark, sf_dir):
    return marts.fact_hourly(*_station_stage(_stations(spark, sf_dir)), STATION)


def clf_training(spark, sf_dir):
    feeds = _hourly(spark, sf_dir)
    return rounded(
        marts.classifier_training(feeds.weather_history, feeds.air_history), "PM25_ROLL24"
    )


def clf_training_strict_label(spark, sf_dir):
    feeds = _hourly(spark, sf_dir)
    mart = marts.classifier_training(feeds.weather_history, feeds.air_history, strict_label=True)
    return rounded(mart, "PM25_ROLL24")


def clf_training_by_station(spark, sf_dir):
    feeds = _stations(spark, sf_dir)
    return rounded(
        marts.classifier_training(feeds.weather_history, feeds.air_history, STATION), "PM25_ROLL24"
    )


def clf_training_blocked(spark, sf_dir):
    """One series with as many rows as there are events."""
    events = sensors.read_events(spark, sf_dir)
    mart = marts.classifier_training(
        sensors.event_weather(events), sensors.event_air(events),
        strategy="blocked", rows_per_block=5_000,
    )
    return rounded(mart, "PM25_ROLL24")


def clf_training_by_station_blocked(spark, sf_dir):
    feeds = _stations(spark, sf_dir)
    mart = marts.classifier_training(
        feeds.weather_history, feeds.air_history, STATION, "blocked", rows_per_block=2_000
    )
    return rounded(mart, "PM25_ROLL24")


def clf_inference(spark, sf_dir):
    f = _hourly(spark, sf_dir)
    mart = marts.classifier_inference(f.weather_history, f.air_history, f.weather_now, f.air_now)
    return rounded(mart, "PM25_ROLL24")


def clf_inference_recent(spark, sf_dir):
    """The same from common hours joined once, as a run does."""
    f = _hourly(spark, sf_dir)
    common = marts.common_hours(f.weather_history, f.air_history, S.ANOMALY_AIR).drop("PM10")
    current = marts.common_hours(f.weather_now, f.air_now, S.CLASSIFIER_AIR)
    recent = latest_rows(common, marts.RECENT_ROWS, [S.TIME])
    mart = marts.newest_features(recent, current)
    return rounded(mart, "PM25_ROLL24")


def clf_inference_by_station(spark, sf_dir):
    f = _stations(spark, sf_dir)
    mart = marts.classifier_inference(
        f.weather_history, f.air_history, f.weather_now, f.air_now, STATION, diagnostics=True
    )
    return rounded(mart, "PM25_ROLL24")


def anomaly_training(spark, sf_dir):
    feeds = _stations(spark, sf_dir)
    return marts.anomaly_rows(feeds.weather_history, feeds.air_history, STATION)


def anomaly_inference(spark, sf_dir):
    feeds = _stations(spark, sf_dir)
    return marts.anomaly_rows(feeds.weather_now, feeds.air_now, STATION)


def feat_doc_only(spark, sf_dir):
    """Wind lag, temperature average and numeric class of the long series."""
    events = sensors.read_events(spark, sf_dir)
    mart = marts.classifier_training(
        sensors.event_weather(events), sensors.event_air(events),
        extra_features=True, strategy="blocked", rows_per_block=5_000,
    )
    coded = mart.withColumn("CLASS_CODE", class_code(F.col("NEXT_HOUR_CLASS")))
    return rounded(
        coded.select(S.TIME, "WIND_SPEED_LAG1", "TEMP_ROLL24", "CLASS_CODE"), "TEMP_ROLL24"
    )


# -- quality ---------------------------------------------------------------


def dq_unique(spark, sf_dir):
    return quality.duplicate_keys(_staging("weather", "as_written")(spark, sf_dir), [S.TIME])


def dq_unique_airquality(spark, sf_dir):
    return quality.duplicate_keys(_staging("airquality", "as_written")(spark, sf_dir), [S.TIME])


def dq_not_null(spark, sf_dir):
    air = sensors.station_air(sensors.read_events(spark, sf_dir))
    return quality.null_rows(air, "PM2_5").select(sensors.STATION, S.TIME)


def dq_summary(spark, sf_dir):
    checks = [
        quality.check_keys(f"stg_{kind}_{mode}", _staging(kind, mode)(spark, sf_dir))
        for kind in S.FIELDS
        for mode in ("unified", "as_written")
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


# -- dashboards ------------------------------------------------------------


def ds_aqi_series(spark, sf_dir):
    daily = datasets.aqi_series(fact_by_station(spark, sf_dir), "day", STATION)
    return rounded(daily, "AVG_AQI", "AVG_PM2_5")


def ds_aqi_hourly(spark, sf_dir):
    hourly = datasets.aqi_series(fact_by_station(spark, sf_dir), "hour")
    return rounded(hourly, "AVG_AQI", "AVG_PM2_5")


def ds_heatmap(spark, sf_dir):
    return rounded(datasets.heatmap(fact_by_station(spark, sf_dir)), "AVG_AQI", "AVG_PM2_5")


def ds_heatmap_grid(spark, sf_dir):
    grid = datasets.heatmap_grid(fact_by_station(spark, sf_dir))
    named = grid.select("DAY_NAME", *[F.col(f"`{h}`").alias(f"H{h:02d}") for h in range(24)])
    return rounded(named, *named.columns[1:])


def ds_wind_scatter(spark, sf_dir):
    return datasets.wind_points(fact_by_station(spark, sf_dir))


def ds_wind_bins(spark, sf_dir):
    return rounded(datasets.wind_bins(fact_by_station(spark, sf_dir)), "AVG_PM2_5")


def ds_wind_trend(spark, sf_dir):
    return rounded(datasets.wind_trend(fact_by_station(spark, sf_dir)), "CORRELATION", "SLOPE")


def ds_hist_vs_rt(spark, sf_dir):
    f = _stations(spark, sf_dir)
    compared = datasets.history_vs_now(f.air_history, f.air_now, series=STATION)
    return rounded(compared, "USUAL_US_AQI", "USUAL_PM2_5", "GAP_US_AQI", "GAP_PM2_5")


def ds_by_source(spark, sf_dir):
    f = _stations(spark, sf_dir)
    return datasets.by_source(f.air_history, f.air_now)


def ds_drivers(spark, sf_dir):
    return rounded(datasets.pollution_drivers(fact_by_station(spark, sf_dir)), "CORRELATION")


# -- models ----------------------------------------------------------------


def anomaly_hourly_band(spark, sf_dir):
    feeds = _stations(spark, sf_dir)
    training = marts.anomaly_rows(feeds.weather_history, feeds.air_history, STATION)
    baseline = anomaly.hour_baseline(training)
    everything = sensors.read_events(spark, sf_dir)
    rows = marts.anomaly_rows(
        sensors.station_weather(everything), sensors.station_air(everything), STATION
    )
    found = anomaly.detect_by_hour(baseline, rows)
    return rounded(
        found, "FORECAST", "LOWER_BOUND", "UPPER_BOUND", "DISTANCE", "PERCENTILE", "ANOMALY_SCORE"
    )


def _fitted(spark, sf_dir):
    """Station training table, written once because the fit reads it repeatedly."""
    feeds = _stations(spark, sf_dir)
    mart = marts.classifier_training(feeds.weather_history, feeds.air_history, STATION)
    training = materialize(mart, "training")
    return feeds, training, classify.fit_classifier(training)


KEYS = (sensors.STATION, S.TIME)


def clf_predict(spark, sf_dir):
    f, _, model = _fitted(spark, sf_dir)
    rows = marts.classifier_inference(
        f.weather_history, f.air_history, f.weather_now, f.air_now, STATION
    )
    return classify.predict(model, rows, keep=KEYS)


def clf_backcast(spark, sf_dir):
    _, training, model = _fitted(spark, sf_dir)
    return classify.predict(model, training, keep=KEYS)


def clf_backcast_contract(spark, sf_dir):
    """Which rows get a prediction, and whether class and probabilities agree."""
    _, training, model = _fitted(spark, sf_dir)
    scored = classify.predict(model, training, on_error="keep_rows", keep=KEYS)
    probs = [F.col(f"PROB_{c.upper()}") for c in S.CLASS_NAMES]
    names = F.array(*[F.lit(c) for c in S.CLASS_NAMES])
    best = F.array_position(F.array(*probs), F.greatest(*probs)).cast("int")
    return scored.select(
        *KEYS,
        F.col("PREDICTED_CLASS").isNotNull().alias("HAS_PREDICTION"),
        F.round(sum(probs[1:], probs[0]), 6).alias("PROB_SUM"),
        (F.col("PREDICTED_CLASS") == F.element_at(names, best)).alias("IS_ARGMAX"),
    )


def _detections(spark, sf_dir) -> DataFrame:
    feeds = _stations(spark, sf_dir)
    training = materialize(
        marts.anomaly_rows(feeds.weather_history, feeds.air_history, STATION), "training"
    )
    return anomaly.detect_anomalies(anomaly.fit_anomaly(training), training, keep=STATION)


def anomaly_detect(spark, sf_dir):
    return _detections(spark, sf_dir)


def anomaly_detect_contract(spark, sf_dir):
    """Which rows are scored, and whether bounds, flag and score agree."""
    d = _detections(spark, sf_dir)
    outside = (F.col("Y") < F.col("LOWER_BOUND")) | (F.col("Y") > F.col("UPPER_BOUND"))
    tail = (F.col("PERCENTILE") < 0.025) | (F.col("PERCENTILE") > 0.975)
    return d.select(
        *STATION, "TS", "Y",
        F.col("FORECAST").between(F.col("LOWER_BOUND"), F.col("UPPER_BOUND")).alias("BRACKETED"),
        (F.col("IS_ANOMALY") == outside).alias("FLAG_MATCHES_BOUNDS"),
        (F.col("IS_ANOMALY") == tail).alias("FLAG_MATCHES_SCORE"),
        (F.col("PERCENTILE") == F.col("ANOMALY_SCORE")).alias("SCORE_IS_PERCENTILE"),
    )


def ds_alerts(spark, sf_dir):
    return datasets.anomaly_alerts(_detections(spark, sf_dir)).drop("CONTRIBUTIONS")


def ds_predictions(spark, sf_dir):
    f, training, model = _fitted(spark, sf_dir)
    rows = marts.classifier_inference(
        f.weather_history, f.air_history, f.weather_now, f.air_now, STATION
    )
    return datasets.class_predictions(
        classify.predict(model, rows, keep=KEYS), classify.predict(model, training, keep=KEYS)
    )


# -- sinks -----------------------------------------------------------------


def store_full_refresh(spark, sf_dir):
    """A refresh, then an empty one that must change nothing."""
    store = VersionedStore(spark, scratch_path(spark, "store"))
    history = _stations(spark, sf_dir).weather_history
    store.refresh_if_nonempty("raw_weather_history", history)
    store.refresh_if_nonempty("raw_weather_history", history.where("OBSERVATION_TIME IS NULL"))
    return store.read("raw_weather_history")


def store_snapshot_pair(spark, sf_dir):
    """Both current-hour tables, refreshed with rows and then with one side empty."""
    store = VersionedStore(spark, scratch_path(spark, "store"))
    f = _stations(spark, sf_dir)
    names = list(streams.REALTIME_TABLES.values())
    parts = []
    for step, air in (("full", f.air_now), ("no_air", f.air_now.where("OBSERVATION_TIME IS NULL"))):
        tables = {names[0]: f.weather_now, names[1]: air}
        store.refresh_together(tables)
        for name in names:
            rows = store.read(name)
            counted = rows.agg(F.count(F.lit(1)).alias("N_ROWS"))
            parts.append(
                counted.select(F.lit(step).alias("STEP"), F.lit(name).alias("TABLE_NAME"), "N_ROWS")
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def landing_redelivery(spark, sf_dir):
    """Both feeds landed twice with changed values: the later delivery of an hour counts."""
    events = sensors.read_events(spark, sf_dir)
    root = scratch_path(spark, "redelivery")
    tables = {"weather": sensors.station_weather(events), "airquality": sensors.station_air(events)}
    parts = []
    for kind, first in (("weather", "TEMPERATURE"), ("airquality", "PM10")):
        table = tables[kind]
        for changed in (table.withColumn(first, F.lit(-1.0)), table):
            _station_payload(changed, kind).drop("obs_date").write.mode("append").json(f"{root}/{kind}")
        landed = payload.read_landing(spark, f"{root}/{kind}", kind, series=("station",), delivery=True)
        rows = payload.hourly_table(landed, kind, ("station", payload.DELIVERY), position=True)
        newest = newest_per_hour(rows, ("station",))
        parts.append(newest.select(F.lit(kind).alias("FEED"), "station", S.TIME, F.col(first).alias("FIRST_MEASURE")))
    return parts[0].unionByName(parts[1])


def current_hour_position(spark, sf_dir):
    """The current hour repeated within a payload: the first place counts, whatever its values."""
    f = _stations(spark, sf_dir)
    twice = f.weather_now.withColumn("TEMPERATURE", F.lit(-1.0)).withColumn("_pos", F.lit(1))
    rows = f.weather_now.withColumn("_pos", F.lit(0)).unionByName(twice)
    return current_hour(rows, f.now, ("station",), "_pos").select("station", *S.WEATHER_COLUMNS)


# -- streaming -------------------------------------------------------------


def _land(spark, sf_dir, times: int) -> str:
    """Station payload files of both feeds, each delivered ``times`` times."""
    events = sensors.read_events(spark, sf_dir)
    root = scratch_path(spark, "landing")
    tables = {"weather": sensors.station_weather(events), "airquality": sensors.station_air(events)}
    for kind, table in tables.items():
        lines = _station_payload(table, kind).drop("obs_date")
        if times > 1:
            lines = materialize(lines, "lines")
        for _ in range(times):
            lines.write.mode("append").json(f"{root}/{kind}")
    return root


def _stream_session(spark: SparkSession) -> SparkSession:
    """A stream keeps its partition count for life, so set it by cores, not by batch habits."""
    child = spark.newSession()
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    child.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    child.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
    return child


def stream_snapshot(spark, sf_dir):
    """Latest hour per station after all payload files have streamed in."""
    root = _land(spark, sf_dir, times=1)
    now = spark.range(1).select(sensors.load_time(sensors.read_events(spark, sf_dir))).first()[0]
    session = _stream_session(spark)
    weather, air = (
        streams.payload_stream(session, f"{root}/{kind}", kind, STATION, delivery=True) for kind in S.FIELDS
    )
    store = scratch_path(spark, "store")
    checkpoint = scratch_path(spark, "checkpoint")
    query = streams.write_snapshot(weather, air, store, now, checkpoint, STATION)
    query.trigger(availableNow=True).start().awaitTermination()
    tables = VersionedStore(spark, store)
    rows = [streams.current_rows(tables, kind, STATION) for kind in S.FIELDS]
    return rows[0].join(rows[1].withColumnRenamed(S.TIME, "AIR_TIME"), sensors.STATION, "full")


def stream_hours_joined(spark, sf_dir):
    """Both feeds delivered twice, de-duplicated and joined as streams."""
    root = _land(spark, sf_dir, times=2)
    session = _stream_session(spark)
    weather, air = (
        streams.once_per_hour(
            streams.payload_stream(session, f"{root}/{kind}", kind, STATION), "60 days", STATION
        )
        for kind in S.FIELDS
    )
    out, checkpoint = scratch_path(spark, "joined"), scratch_path(spark, "checkpoint")
    joined = streams.join_hours(weather, air, STATION)
    query = joined.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(joined.schema).parquet(out)


def all_queries() -> dict[str, Query]:
    named = [
        ingest_rename_cast, ingest_strict, json_props_extract, hourly_payload_inline,
        landing_range, landing_redelivery, history_cutoff, current_hour_position, current_hour_weather, current_hour_airquality,
        fact_hourly, fact_by_station, clf_training, clf_training_strict_label,
        clf_training_by_station, clf_training_blocked, clf_training_by_station_blocked,
        clf_inference, clf_inference_recent, clf_inference_by_station, anomaly_training, anomaly_inference,
        feat_doc_only, dq_unique, dq_unique_airquality, dq_not_null, dq_summary,
        ds_aqi_series, ds_aqi_hourly, ds_heatmap, ds_heatmap_grid, ds_wind_scatter, ds_wind_bins,
        ds_wind_trend, ds_hist_vs_rt, ds_by_source, ds_drivers, anomaly_hourly_band, clf_predict, clf_backcast,
        clf_backcast_contract, anomaly_detect, anomaly_detect_contract, ds_alerts, ds_predictions,
        store_full_refresh, store_snapshot_pair, stream_snapshot, stream_hours_joined,
    ]
    from workload import runs  # which builds on the queries above

    queries: dict[str, Query] = {q.__name__: q for q in named} | runs.all_queries()
    for kind in S.FIELDS:
        for mode in ("as_written", "unified"):
            queries[f"stg_{kind}_{mode}"] = _staging(kind, mode)
    return queries
