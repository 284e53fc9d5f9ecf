"""One hourly run: load, build, check, then train and score.

Stages follow each other inside one Spark application. Every table goes through
the versioned store, by day: a run writes the days that changed and the rows that
features of changed days reach, and leaves the files of all other days. Staging
and marts stay invisible until the key checks pass, so a refused or failed run
leaves the former tables readable.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from airmart import schemas as S
from airmart.operators import days as D, quality
from airmart.operators.coerce import before_cutoff, current_hour
from airmart.operators.dedup import unite
from airmart.operators.store import Transaction, VersionedStore, create_views, publish_view
from airmart.plans import anomaly, classify, datasets, marts
from airmart.session import scratch_scope
from airmart.operators.latest import latest_rows, newest_per_hour
from airmart.sources.landing import hour_days, landed_marks, of_folders, plan_load
from airmart.sources.payload import (
    DELIVERY, LANDING_DATE, POSITION, hourly_table, newest_delivery, read_landing,
)
from airmart.streaming.hourly import REALTIME_TABLES

log = logging.getLogger(__name__)

# Database of each table's view.
LAYERS = {
    "raw": (
        "raw_weather_history", "raw_airquality_history", "raw_weather_realtime", "raw_airquality_realtime",
    ),
    "staging": ("stg_weather", "stg_airquality"),
    "analytics": (
        "fact_hourly", "classifier_training", "classifier_inference", "anomaly_training",
        "anomaly_inference", "final_prediction_clean", "final_prediction_historical",
        "realtime_anomaly_preds", "ds_aqi_daily", "ds_heatmap", "ds_wind_bins", "ds_wind_trend",
        "ds_history_vs_now", "ds_drivers", "ds_alerts", "ds_predictions",
    ),
}

HISTORY_TABLES = {"weather": "raw_weather_history", "airquality": "raw_airquality_history"}


@dataclass(frozen=True)
class Options:
    """Choices where the plain reading of the rules and a safer one differ."""

    series: tuple[str, ...] = ()
    dedup: str = "unified"
    # "table" ranks the union once and lets fact and checks read the result;
    # "view" repeats the ranking in each of them and stores nothing.
    staging: str = "table"
    strategy: str = "blocked"
    # Range partitions and rows of a window block; None takes the session's and the default.
    num_partitions: int | None = None
    rows_per_block: int | None = None
    # Rows of the rolling average, or hours with ``time_based``: then frames go by the clock.
    roll_rows: int = marts.ROLL_ROWS
    time_based: bool = False
    strict_label: bool = False
    strict_realtime: bool = False
    unknown_label: str | None = None
    prediction_interval: float = anomaly.INTERVAL
    # How long superseded commits stay for readers that hold no lease.
    retention: timedelta = timedelta(hours=2)


class Refresh:
    """The stages of a run over one landing folder and one store.

    Landing layout: ``<landing>/<kind>_history/obs_date=YYYY-MM-DD/*.json`` and
    ``<landing>/<kind>_realtime/*.json`` for kind weather and airquality.
    """

    def __init__(
        self, spark: SparkSession, landing: str, root: str, now: datetime,
        options: Options = Options(),
    ):
        self.spark, self.landing, self.now, self.options = spark, landing.rstrip("/"), now, options
        self.store = VersionedStore(spark, root)
        self._open: Transaction | None = None

    @contextmanager
    def _writing(self) -> Iterator[Transaction]:
        """The open transaction, or one of its own."""
        if self._open:
            yield self._open
            return
        with self.store.transaction() as own:
            self._open = own
            try:
                yield own
            finally:
                self._open = None

    def _tables(self) -> Transaction | VersionedStore:
        return self._open or self.store

    # -- load ------------------------------------------------------------

    def load_history(self, kind: str) -> int:
        """Bring a history table up to date with its landing; returns its rows.

        Only landing folders that changed, or hold hours of a day that did, are read,
        and only days that changed are written. A landing without any row leaves the
        table as it is.
        """
        table, path, series = HISTORY_TABLES[kind], f"{self.landing}/{kind}_history", self.options.series
        landed = read_landing(
            self.spark, path, kind, self.now, series=series, keep_date=True, delivery=True,
        )
        with self._writing() as own:
            notes = own.table(table).facts if own.exists(table) else {}
            marks = landed_marks(self.spark, path, self.now, kind)
            plan = plan_load(marks, lambda days: hour_days(of_folders(landed, days)), notes, self.now, series)
            if plan.nothing:
                if plan.notes != notes:
                    own.note(table, plan.notes)
                return own.table(table).rows
            payload = landed if plan.days is None else of_folders(landed, plan.folders)
            keep = (*series, DELIVERY)
            rows = before_cutoff(hourly_table(payload, kind, keep, position=True), self.now)
            rows = newest_per_hour(self._of_days(rows, plan.days), series)
            count = own.write_days(table, rows, F.to_date(S.TIME), plan.days, plan.notes)
            if count == 0:
                own.forget(table)
            return count

    def load_realtime(self) -> dict[str, int]:
        tables = {}
        for kind, table in REALTIME_TABLES.items():
            payload = read_landing(
                self.spark, f"{self.landing}/{kind}_realtime", kind, series=self.options.series,
                delivery=True,
            )
            payload = newest_delivery(payload, self.options.series)
            # Strictness covers the kept hour only, so select it before the strict cast.
            strict = self.options.strict_realtime and kind == "weather"
            rows = hourly_table(payload, kind, self.options.series, position=True)
            here = current_hour(rows, self.now, self.options.series, POSITION)
            tables[table] = _require_measures(here, kind) if strict else here
        with self._writing() as own:
            counts = {name: own.write(name, df) for name, df in tables.items()}
        for table, rows in counts.items():
            if rows == 0:
                log.warning("%s: no row for the hour of %s", table, self.now)
        return counts

    # -- build -----------------------------------------------------------

    def raw(self, kind: str, days: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
        tables = self._tables()
        now = self._of_days(tables.read(REALTIME_TABLES[kind]), days)
        return tables.read(HISTORY_TABLES[kind], days), now

    @staticmethod
    def _of_days(df: DataFrame, days: Iterable[str] | None, time: str = S.TIME) -> DataFrame:
        return df if days is None else df.where(D.is_one_of(D.day_text(time), days))

    def _write_changed(
        self, own: Transaction, target: str, inputs: tuple[str, ...], make, choices: dict,
        time: str = S.TIME, reach=None,
    ) -> set[str] | None:
        """Write the days of ``target`` that inputs changed, and returns them (None: all).

        ``make(days)`` gives rows of these days, ``reach(days)`` adds days whose rows depend
        on them. Which writes a day was made of, and by which choices, stays with the table.
        """
        made_of = D.writes_by_day({n: own.table(n) for n in inputs}, own.read, S.TIME)
        notes = own.table(target).facts if own.exists(target) else {}
        facts = {"inputs": made_of, "choices": {"series": list(self.options.series), **choices}}
        days = None
        if notes.get("choices") == facts["choices"]:
            days = D.changed_days(made_of, notes["inputs"])
            if not days:
                return days
            days |= reach(days) if reach else set()
        own.write_days(target, self._of_days(make(days), days, time), F.to_date(time), days, facts)
        return days

    def stage(self) -> None:
        """Unite both loads of each kind and expose them as session views."""
        o = self.options
        with self._writing() as own:
            for kind in S.FIELDS:
                name, inputs = f"stg_{kind}", (HISTORY_TABLES[kind], REALTIME_TABLES[kind])
                if o.staging == "table":
                    make = lambda days: unite(*self.raw(kind, days), o.dedup, o.series)  # noqa: B023, E731
                    self._write_changed(own, name, inputs, make, {"dedup": o.dedup})
                create_views({name: self._staged(kind)})

    def _staged(self, kind: str, days: Iterable[str] | None = None) -> DataFrame:
        if self.options.staging == "table":
            return self._tables().read(f"stg_{kind}", days)
        return unite(*self.raw(kind, days), self.options.dedup, self.options.series)

    def staged(self) -> dict[str, DataFrame]:
        return {f"stg_{kind}": self.spark.table(f"stg_{kind}") for kind in S.FIELDS}

    def build(self) -> None:
        with self._writing():
            self.stage()
            self.build_fact()
            self.build_history()
            self.build_current()

    def build_fact(self) -> None:
        o = self.options
        loads = tuple(t for kind in S.FIELDS for t in (HISTORY_TABLES[kind], REALTIME_TABLES[kind]))
        inputs = ("stg_weather", "stg_airquality") if o.staging == "table" else loads
        choices = {"unknown_label": o.unknown_label, "dedup": o.dedup, "staging": o.staging}

        def make(days):
            return marts.fact_hourly(
                self._staged("weather", days), self._staged("airquality", days), o.series, o.unknown_label
            )

        with self._writing() as own:
            self._write_changed(own, "fact_hourly", inputs, make, choices)

    def build_history(self) -> None:
        """Common hours, detector rows and classifier rows of the days that changed.

        Features of a row reach 24 rows back and one forth, so a changed day also changes
        the 24 rows after it and the row before; and these need the rows their own
        frames reach. Rows of each series and day are counted to find those days.
        """
        o = self.options
        loads = tuple(HISTORY_TABLES.values())

        def joined(days):
            tables = self._tables()
            weather, air = (tables.read(HISTORY_TABLES[kind], days) for kind in S.FIELDS)
            return marts.common_hours(weather, air, S.ANOMALY_AIR, o.series)

        with self._writing() as own:
            # History is joined once: detector rows, classifier rows and the latest hours all come from it.
            self._write_changed(own, "common_hours", loads, joined, {})
            readings = lambda days: marts.with_reading(own.read("common_hours", days))
            detector = lambda days: readings(days).withColumnRenamed(S.TIME, "TS")
            self._write_changed(own, "anomaly_training", ("common_hours",), detector, {}, time="TS")
            by_day = lambda days: readings(days).groupBy(*o.series, F.to_date(S.TIME).alias(S.TIME)).agg(F.count("*").alias("n"))
            self._write_changed(own, "reading_counts", ("common_hours",), by_day, {})
            counts = own.read("reading_counts").withColumn(D.DAY_COLUMN, F.col(S.TIME).cast("string"))
            back, forth = max(2, o.roll_rows - 1), 1

            def near(days, ahead, behind):
                if o.time_based:
                    return D.shifted(days, ahead, behind) - set(days)
                return D.near_days(counts, days, ahead, behind, o.series)

            def features(days):
                needed = days if days is None else days | near(days, forth, back)
                return marts.classifier_rows(
                    own.read("common_hours", needed).drop("PM10"), o.series, o.strategy, o.strict_label,
                    time_based=o.time_based, roll_rows=o.roll_rows,
                    num_partitions=o.num_partitions, rows_per_block=o.rows_per_block,
                )

            with scratch_scope(self.spark):
                self._write_changed(
                    own, "classifier_training", ("common_hours",), features,
                    {"strict": o.strict_label, "roll": o.roll_rows, "time_based": o.time_based},
                    reach=lambda days: near(days, back, forth),
                )

    def build_current(self) -> None:
        """Rows to score: the latest of each series."""
        o = self.options
        with self._writing() as own:
            weather_now, air_now = (own.read(t) for t in REALTIME_TABLES.values())
            own.write("anomaly_inference", marts.anomaly_rows(weather_now, air_now, o.series))
            recent = latest_rows(own.read("common_hours").drop("PM10"), marts.RECENT_ROWS, [S.TIME], o.series)
            current = marts.common_hours(weather_now, air_now, S.CLASSIFIER_AIR, o.series)
            own.write("classifier_inference", marts.newest_features(recent, current, o.series))

    def check(self) -> None:
        quality.gate(self.staged(), self.options.series)

    def release(self) -> None:
        """Build, audit, and only then let readers see staging and marts."""
        with self._writing():
            self.build()
            self.check()

    # -- models ----------------------------------------------------------

    def run_classifier(self) -> None:
        """Train, store with what the model was trained on, then score."""
        with self._writing() as own:
            training = own.read("classifier_training")
            model = classify.fit_classifier(training)
            own.write_model("classifier_model", model, classify.describe(training))
        self.score_classes()

    def score_classes(self) -> None:
        """Score current and past rows with the stored model; a model of other features is refused."""
        keep = (*self.options.series, S.TIME)
        with self._writing() as own:
            model = classify.load_classifier(own)
            own.write("final_prediction_clean", classify.predict(model, own.read("classifier_inference"), keep=keep))
            # Scores of the rows the model was fitted on: a back-cast, not an evaluation.
            past = classify.predict(model, own.read("classifier_training"), keep=keep)
            own.write("final_prediction_historical", past)

    def run_anomaly(self) -> None:
        with self._writing() as own:
            training = own.read("anomaly_training")
            model = anomaly.fit_anomaly(training)
            fitted = self.spark.range(1).select(F.lit(model.to_json()).alias("model"))
            own.write("anomaly_model", fitted, anomaly.describe(model, training))
        self.score_anomalies()

    def score_anomalies(self) -> None:
        """Score the current rows with the stored detector."""
        with self._writing() as own:
            found = anomaly.detect_anomalies(
                anomaly.load_detector(own), own.read("anomaly_inference"),
                self.options.prediction_interval, self.options.series,
            )
            own.write("realtime_anomaly_preds", found)

    def publish_datasets(self) -> None:
        with self._writing() as own:
            fact = own.read("fact_hourly")
            air, air_now = self.raw("airquality")
            tables = {
                "ds_aqi_daily": datasets.aqi_series(fact, "day", self.options.series),
                "ds_heatmap": datasets.heatmap(fact),
                "ds_wind_bins": datasets.wind_bins(fact),
                "ds_wind_trend": datasets.wind_trend(fact),
                "ds_history_vs_now": datasets.history_vs_now(air, air_now, series=self.options.series),
                "ds_drivers": datasets.pollution_drivers(fact),
                "ds_alerts": datasets.anomaly_alerts(own.read("realtime_anomaly_preds")),
                "ds_predictions": datasets.class_predictions(
                    own.read("final_prediction_clean"), own.read("final_prediction_historical"),
                ),
            }
            for name, df in tables.items():
                own.write(name, df)

    def publish_views(self, prefix: str = "") -> list[str]:
        """Name every stored table in the catalog, one database per layer.

        The views look up the newest commit themselves, so they all follow it at one instant.
        """
        names = []
        for layer, tables in LAYERS.items():
            database = f"{prefix}{layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            for table in tables:
                if self.store.exists(table) and publish_view(self.store, table, f"{database}.{table}"):
                    names.append(f"{database}.{table}")
        return names

    def prune(self) -> None:
        """Drop commits that were superseded long enough ago and that no reader leased."""
        self.store.prune(self.options.retention)

    def run(self) -> None:
        """All stages; a failed check leaves staging and marts as they were, and no model is trained."""
        try:
            self.load_history("weather")
            self.load_history("airquality")
            self.load_realtime()
            self.release()
            self.run_anomaly()
            self.run_classifier()
            self.publish_datasets()
            self.publish_views()
        finally:
            self.prune()


def _require_measures(rows: DataFrame, kind: str) -> DataFrame:
    """Fail the job if the kept row misses a measure."""
    columns = []
    for name in rows.columns:
        value = F.col(name)
        if name in S.FIELDS[kind].values() and name != S.TIME:
            problem = F.raise_error(F.lit(f"{name} is missing")).cast(S.column_type(name))
            value = F.when(value.isNull(), problem).otherwise(value)
        columns.append(value.alias(name))
    return rows.select(*columns)
