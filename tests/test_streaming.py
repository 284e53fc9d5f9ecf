"""Streams over landed files: re-delivery, late files, restart."""

import json
import time

import pytest
from pyspark.sql import functions as F

from airmart import schemas as S
from airmart.operators.store import VersionedStore
from airmart.session import ROCKSDB_STATE
from airmart.streaming import hourly as streams
from tests.helpers import at, column, table


def deliver(folder, kind, name, hours, value=1.0):
    folder = folder / kind
    folder.mkdir(parents=True, exist_ok=True)
    hourly = {f: [value] * len(hours) for f in S.FIELDS[kind]}
    hourly["time"] = [at(h).strftime("%Y-%m-%dT%H:%M") for h in hours]
    # Written aside first: a stream must never list a half-written file.
    draft = folder / f".{name}"
    draft.write_text(json.dumps({"hourly": hourly}))
    draft.rename(folder / name)


@pytest.fixture
def feed(spark, tmp_path):
    landing, root, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")

    def run(now=at(100), **options):
        rows = [
            streams.payload_stream(spark, f"{landing}/{kind}", kind, delivery=True, **options) for kind in S.FIELDS
        ]
        writer = streams.write_snapshot(*rows, root, now, checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        store = VersionedStore(spark, root)
        return {
            kind: [(r.OBSERVATION_TIME, r[3]) for r in streams.current_rows(store, kind).collect()]
            for kind in S.FIELDS
        }

    return landing, run


def test_snapshot_never_moves_back(feed):
    landing, run = feed
    for kind in S.FIELDS:
        deliver(landing, kind, "b.json", range(4, 8), 2.0)
    assert run() == {k: [(at(7), 2.0)] for k in S.FIELDS}
    for kind in S.FIELDS:
        deliver(landing, kind, "a.json", range(0, 4), 3.0)
    assert run() == {k: [(at(7), 2.0)] for k in S.FIELDS}


def test_snapshot_stops_at_the_current_hour_and_takes_corrections(feed):
    landing, run = feed
    for kind in S.FIELDS:
        deliver(landing, kind, "a.json", range(0, 24))
    assert run(at(9.5))["weather"] == [(at(9), 1.0)]
    deliver(landing, "weather", "b.json", [9], 5.0)
    assert run(at(9.5)) == {"weather": [(at(9), 5.0)], "airquality": [(at(9), 1.0)]}


def test_many_batches_and_restart_without_new_files(feed):
    landing, run = feed
    for kind in S.FIELDS:
        for i in range(3):
            deliver(landing, kind, f"{i}.json", range(i * 4, i * 4 + 4), float(i))
    first = run(maxFilesPerTrigger="1")
    assert first == {k: [(at(11), 2.0)] for k in S.FIELDS}
    assert run(maxFilesPerTrigger="1") == first


def test_a_batch_writes_only_what_moved(spark, feed, tmp_path):
    landing, run = feed
    for kind in S.FIELDS:
        deliver(landing, kind, "a.json", range(0, 10))
    run()
    deliver(landing, "weather", "b.json", range(5, 12))
    deliver(landing, "airquality", "b.json", range(0, 5))
    run()
    parts = {n: [p.rows for p in t.parts] for n, t in VersionedStore(spark, str(tmp_path / "store")).snapshot().tables.items()}
    assert parts == {"weather_arrivals": [1, 1], "airquality_arrivals": [1]}


def test_of_equal_hours_the_later_delivery_counts_whatever_its_values(feed):
    landing, run = feed
    for name, value in (("z.json", 9.0), ("a.json", 1.0)):  # a.json lands last
        for kind in S.FIELDS:
            deliver(landing, kind, name, range(0, 6), value)
        time.sleep(0.02)
    assert run() == {k: [(at(5), 1.0)] for k in S.FIELDS}


def arrivals(spark, kind, rows):
    landed = table(spark, kind, rows).withColumns({c: F.lit(v) for c, v in zip((*streams.LANDED, streams.PLACE), (1, "f", 0))})
    return landed.withColumn(streams.FEED, F.lit(kind))


def test_replayed_batch_and_folding_change_nothing(spark, tmp_path):
    apply = streams.snapshot_batches(str(tmp_path / "s"))
    batch = arrivals(spark, "weather", [{"h": 2, "RAIN": 4}]).unionByName(arrivals(spark, "airquality", [{"h": 2}]), allowMissingColumns=True)
    apply(batch, 0)
    store = VersionedStore(spark, str(tmp_path / "s"))
    before = streams.current_rows(store, "weather").collect()
    apply(batch, 0)
    assert streams.current_rows(store, "weather").collect() == before and [r.RAIN for r in before] == [4.0]
    streams.fold_arrivals(store)
    assert store.read("weather_arrivals").count() == 1 and streams.current_rows(store, "weather").collect() == before
    assert store.read("raw_weather_realtime").collect() == before
    streams.snapshot_batches(str(tmp_path / "s"), fold_after=1)(batch, 1)
    assert [len(store.snapshot().table(t).parts) for t in streams.ARRIVALS.values()] == [1, 1]


def test_a_stream_leaves_a_running_reader_whole(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    apply = streams.snapshot_batches(store.root, fold_after=1)
    batch = lambda h: arrivals(spark, "weather", [{"h": h}]).unionByName(arrivals(spark, "airquality", [{"h": h}]), allowMissingColumns=True)
    apply(batch(1), 0)
    with store.reading() as held:
        for h in range(2, 6):
            apply(batch(h), h)
        assert column(streams.current_rows(held, "weather"), S.TIME) == [at(1)]
    assert column(streams.current_rows(store, "weather"), S.TIME) == [at(5)]


def test_every_delivered_row_has_a_fate(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        feeds = (streams.payload_stream(spark, f"{landing}/{kind}", kind) for kind in S.FIELDS)
        judged = streams.delivery_fates(streams.tagged_pair(*feeds), "6 hours")
        streams.write_fates(judged, out, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        found = spark.read.schema(judged.schema).parquet(out)
        return {r.FEED: (r.DELIVERED, r.ACCEPTED, r.REPEATED, r.LATE) for r in streams.fate_counts(found).collect()}

    for kind in S.FIELDS:
        deliver(landing, kind, "a.json", [*range(0, 10), 9])
    assert run() == {k: (11, 10, 1, 0) for k in S.FIELDS}
    deliver(landing, "weather", "b.json", [1, 2, 3, 5, 10])  # the watermark stands at hour 3
    deliver(landing, "airquality", "b.json", [])
    assert run() == {"weather": (16, 11, 3, 2), "airquality": (11, 10, 1, 0)}
    deliver(landing, "airquality", "c.json", [3, 4, 30])
    assert run()["airquality"] == (14, 11, 2, 1)
    deliver(landing, "weather", "d.json", [23, 24, 31])
    assert run()["weather"] == (19, 13, 3, 3)


@pytest.fixture(params=["heap", "rocksdb"])
def state_store(spark, request):
    key = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, ROCKSDB_STATE if request.param == "rocksdb" else heap)
    yield request.param
    spark.conf.set(key, ROCKSDB_STATE)


def test_once_per_hour_and_join(spark, tmp_path, state_store):
    landing = tmp_path / "in"
    for kind in S.FIELDS:
        deliver(landing, kind, "a.json", range(0, 6))
        deliver(landing, kind, "b.json", range(2, 8))
    deliver(landing, "weather", "c.json", range(0, 10))
    sides = [
        streams.once_per_hour(
            streams.payload_stream(spark, f"{landing}/{kind}", kind, maxFilesPerTrigger="1")
        )
        for kind in S.FIELDS
    ]
    joined = streams.join_hours(*sides)
    out = str(tmp_path / "out")

    def run():
        query = joined.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        query.trigger(availableNow=True).start(out).awaitTermination()
        return column(spark.read.schema(joined.schema).parquet(out), "TS", "TS")

    assert run() == [at(h) for h in range(8)]
    for kind in S.FIELDS:
        deliver(landing, kind, "again.json", range(0, 8))
    assert run() == [at(h) for h in range(8)]


def test_fates_of_many_series_share_state(spark, tmp_path):
    """State holds a row per bucket, not per series, and keeps series apart, one without a name too."""
    landing, out = tmp_path / "in", str(tmp_path / "out")
    names = [None, "", *map(str, range(40))]

    def run(**hours):
        for kind, rows in hours.items():
            (landing / kind).mkdir(parents=True, exist_ok=True)
            table = S.FIELDS[kind]
            entry = lambda h: {f: at(h).isoformat() if f == "time" else 1.0 for f in table}
            lines = [json.dumps({"station": n, "hourly": {f: [entry(h)[f] for h in own] for f in table}}) for n, own in rows]
            (landing / kind / f"{len(list((landing / kind).iterdir()))}.json").write_text("\n".join(lines))
        feeds = (streams.payload_stream(spark, f"{landing}/{kind}", kind, ("station",)) for kind in S.FIELDS)
        judged = streams.delivery_fates(streams.tagged_pair(*feeds), "6 hours", ("station",), buckets=3)
        query = streams.write_fates(judged, out, str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        states.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress))
        found = spark.read.schema(judged.schema).parquet(out)
        return {r.FEED: (r.DELIVERED, r.ACCEPTED, r.REPEATED, r.LATE) for r in streams.fate_counts(found).collect()}

    states = []
    first = run(weather=[(n, [1, 2, 10]) for n in names], airquality=[(n, [10]) for n in names])
    assert first == {"weather": (126, 126, 0, 0), "airquality": (42, 42, 0, 0)}
    again = run(weather=[(None, [10, 11]), ("", [10, 3]), ("7", [10, 12])], airquality=[("new", [10])])
    assert again == {"weather": (132, 128, 3, 1), "airquality": (43, 43, 0, 0)}
    assert max(states) <= 3
