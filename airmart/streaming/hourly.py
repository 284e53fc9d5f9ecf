"""Streams of landed payloads.

A watermark needs a zoned timestamp, so streams carry ``EVENT_TS`` beside the
zone-free time key and drop it on the way out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructField, StructType

from airmart import schemas as S
from airmart.functions import this_hour
from airmart.operators.latest import latest_rows
from airmart.operators.store import VersionedStore
from airmart.sources.payload import POSITION, hourly_table

EVENT_TS = "EVENT_TS"
FEED = "FEED"
FATE = "FATE"
ACCEPTED, REPEATED, LATE = "accepted", "repeated", "late"
REALTIME_TABLES = {"weather": "raw_weather_realtime", "airquality": "raw_airquality_realtime"}
# Rows that moved a series' latest hour, one write per batch.
ARRIVALS = {"weather": "weather_arrivals", "airquality": "airquality_arrivals"}
# When a row's file was landed, its name, and the row's place in its payload. Rows reach stateful
# functions as named tuples, which take no names that begin with an underscore.
LANDED, PLACE = ("LANDED", "FILE_NAME"), "PLACE"
FOLD_AFTER = 200  # batches whose arrivals stay apart
FATE_BUCKETS = 256  # groups of series that are judged in one call


def payload_stream(
    spark: SparkSession, path: str, kind: str, series: tuple[str, ...] = (), delivery: bool = False,
    **options: str,
) -> DataFrame:
    """Typed hourly rows of payload files as they land; ``delivery`` adds when, in which file and where in it."""
    reader = spark.readStream.schema(S.payload_schema(kind, series)).options(**options)
    if not delivery:
        return hourly_table(reader.json(path), kind, series)
    landed = reader.json(path).withColumns({
        LANDED[0]: F.unix_micros("_metadata.file_modification_time"), LANDED[1]: F.col("_metadata.file_name"),
    })
    return hourly_table(landed, kind, (*series, *LANDED), position=True).withColumnRenamed(POSITION, PLACE)


def once_per_hour(
    rows: DataFrame, late: str = "2 days", series: tuple[str, ...] = ()
) -> DataFrame:
    """One row per hour under repeated delivery; state is bounded by ``late``."""
    stamped = rows.withColumn(EVENT_TS, F.col(S.TIME).cast("timestamp"))
    return stamped.withWatermark(EVENT_TS, late).dropDuplicatesWithinWatermark([*series, S.TIME])


def join_hours(
    weather: DataFrame, air: DataFrame, series: tuple[str, ...] = ()
) -> DataFrame:
    """Stream-stream inner join of two ``once_per_hour`` streams.

    The equality on event time bounds the state of both sides; the zone-free
    time joins too, as two of its hours can share one zoned instant.
    """
    keys = [*series, EVENT_TS, S.TIME]
    right = air.select(*keys, *S.ANOMALY_AIR)
    return weather.join(right, keys).select(
        *series, F.col(S.TIME).alias("TS"), *S.CLASSIFIER_WEATHER, *S.ANOMALY_AIR
    )


def tagged_pair(weather: DataFrame, air: DataFrame) -> DataFrame:
    """Both feeds as one stream, so that one batch can update both tables."""
    return weather.withColumn(FEED, F.lit("weather")).unionByName(
        air.withColumn(FEED, F.lit("airquality")), allowMissingColumns=True
    )


class LatestHour(StatefulProcessor):
    """Per series and feed, lets a row through only if it moves the latest hour or corrects it.

    Rows compete by hour, then by delivery, then by their place in the payload, the first
    one winning. The state is those few numbers, not the row.
    """

    ORDER = ("AT", *LANDED, "RANK")

    def init(self, handle) -> None:
        self.latest = handle.getValueState("latest", "at long, landed long, file string, rank long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        found, best = None, tuple(self.latest.get()) if self.latest.exists() else None
        for part in rows:
            part = part.sort_values(list(self.ORDER)).tail(1)
            own = tuple(x.item() if hasattr(x, "item") else x for x in part[list(self.ORDER)].iloc[0])
            if best is None or own > best:
                found, best = part, own
        if found is not None:
            self.latest.update(best)
            yield found

    def close(self) -> None:
        pass


def moving_rows(pair: DataFrame, now: datetime | None = None, series: tuple[str, ...] = ()) -> DataFrame:
    """Of a ``tagged_pair`` of streams with delivery, the rows that change what is current.

    Hours after ``now``, by default the time of the batch, do not count. Needs RocksDB state.
    """
    hour = this_hour(now if now is not None else F.current_timestamp().cast("timestamp_ntz"))
    ranked = pair.where(F.col(S.TIME) <= hour).withColumns({
        "AT": F.unix_micros(F.col(S.TIME).cast("timestamp")), "RANK": -F.col(PLACE),
    })
    return ranked.groupBy(*series, FEED).transformWithStateInPandas(
        LatestHour(), outputStructType=ranked.schema, outputMode="Update", timeMode="None"
    )


def snapshot_batches(
    root: str, series: tuple[str, ...] = (), fold_after: int = FOLD_AFTER
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function adding the rows that moved to both feeds' arrivals, at one instant.

    A batch writes no more rows than it has. Replaying one adds rows that change nothing.
    Every ``fold_after`` batches arrivals are folded to one row per series.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        store = VersionedStore(batch.sparkSession, root)
        batch.persist()  # read once for both tables
        try:
            with store.transaction() as own:
                for kind, table in ARRIVALS.items():
                    columns = [*series, *S.FIELDS[kind].values(), *LANDED, PLACE]
                    own.append(table, batch.where(F.col(FEED) == kind).select(*columns))
        finally:
            batch.unpersist()
        parts = [len(t.parts) for n, t in store.snapshot().tables.items() if n in ARRIVALS.values()]
        if max(parts, default=0) > fold_after:
            fold_arrivals(store, series)
            store.prune()

    return apply


def current_rows(store, kind: str, series: tuple[str, ...] = ()) -> DataFrame:
    """The latest row of each series that has arrived; ``store`` may be a snapshot."""
    rows = store.read(ARRIVALS[kind]).withColumn(PLACE, -F.col(PLACE))
    return latest_rows(rows, 1, [S.TIME, *LANDED, PLACE], series).drop(*LANDED, PLACE)


def fold_arrivals(store: VersionedStore, series: tuple[str, ...] = ()) -> None:
    """Write the current-hour tables, and keep of the arrivals only what is current."""
    with store.transaction() as own:
        for kind, table in ARRIVALS.items():
            arrived = own.read(table)
            rows = latest_rows(arrived.withColumn("RANK", -F.col(PLACE)), 1, [S.TIME, *LANDED, "RANK"], series)
            own.write(table, rows.drop("RANK"))
            own.write(REALTIME_TABLES[kind], own.read(table).drop(*LANDED, PLACE))


def write_snapshot(
    weather: DataFrame,
    air: DataFrame,
    root: str,
    now: datetime | None,
    checkpoint: str,
    series: tuple[str, ...] = (),
) -> DataStreamWriter:
    """Writer of what is current in two streams with delivery; the caller picks the trigger and starts it."""
    moved = moving_rows(tagged_pair(weather, air), now, series)
    writer = moved.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(snapshot_batches(root, series))


def delivery_fates(
    pair: DataFrame, late: str = "2 days", series: tuple[str, ...] = (), buckets: int = FATE_BUCKETS
) -> DataFrame:
    """Every delivered row of a ``tagged_pair`` with its fate, so that none vanishes unaccounted for.

    ``late``: its hour lay behind the watermark when it came. ``repeated``: the hour of its
    feed and series had come before, in this batch or since the watermark. ``accepted``:
    all others. State holds the hours that are not behind the watermark, of many series in
    one bucket, as a call per series would cost more than its rows. A checkpoint keeps its
    number of ``buckets``.
    """
    stamped = pair.withColumn(EVENT_TS, F.col(S.TIME).cast("timestamp")).withWatermark(EVENT_TS, late)
    at = F.unix_millis(EVENT_TS)
    name = F.to_json(F.struct(*series)) if series else F.lit("")
    bucket = F.pmod(F.xxhash64(*series), F.lit(buckets)) if series else F.lit(0)
    keyed = stamped.withColumns({
        "_at": at, "_entry": F.concat_ws(" ", F.coalesce(at.cast("string"), F.lit("")), FEED, name), "_bucket": bucket,
    })

    def judge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        seen = set(state.get[0]) if state.exists else set()
        for part in parts:
            entry, behind = part["_entry"], part["_at"] < mark
            again = (entry.duplicated() & ~behind) | entry.isin(seen)
            fate = pd.Series(ACCEPTED, index=part.index).mask(again, REPEATED).mask(behind, LATE)
            seen |= set(entry[~behind].tolist())
            yield part.assign(**{FATE: fate})
        times = ((e, e.split(" ", 1)[0]) for e in seen)
        state.update(([e for e, t in times if t and int(t) >= mark],))

    schema = StructType([*keyed.schema.fields, StructField(FATE, StringType())])
    judged = keyed.groupBy("_bucket").applyInPandasWithState(
        judge, schema, "seen array<string>", "append", GroupStateTimeout.NoTimeout
    )
    return judged.drop("_at", "_entry", "_bucket", EVENT_TS)


def write_fates(judged: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Writer of judged rows, a folder for each feed and fate."""
    writer = judged.writeStream.format("parquet").partitionBy(FEED, FATE)
    return writer.option("checkpointLocation", checkpoint).option("path", out)


def fate_counts(judged: DataFrame) -> DataFrame:
    """Rows delivered to each feed, and what became of them."""
    counted = {f: F.count_if(F.col(FATE) == f).alias(f.upper()) for f in (ACCEPTED, REPEATED, LATE)}
    return judged.groupBy(FEED).agg(F.count("*").alias("DELIVERED"), *counted.values())
