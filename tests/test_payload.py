"""Landed JSON files."""

import json
import os

import pytest

from airmart import schemas as S
from airmart.operators.latest import newest_per_hour
from airmart.sources.payload import (
    DELIVERY, explode_hourly, hourly_table, newest_delivery, read_landing, to_payload,
)
from tests.helpers import at, column, table


def land(path, hourly, **extra):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"hourly": hourly, **extra}))


def air(times, **columns):
    hourly = {f: [1.0] * len(times) for f in S.AIR_FIELDS}
    return {**hourly, "time": times, **columns}


def test_reads_parallel_arrays(spark, tmp_path):
    land(tmp_path / "a.json", air(["2024-01-01T00:00", "2024-01-01T01:00"], pm2_5=[5, None]), elevation=3)
    got = hourly_table(read_landing(spark, str(tmp_path), "airquality"), "airquality")
    assert got.schema == S.table_schema("airquality")
    assert column(got, "OBSERVATION_TIME") == [at(0), at(1)]
    assert column(got, "PM2_5") == [5.0, None]


WHOLE = json.dumps({"hourly": air(["2024-01-01T00:00", "2024-01-01T01:00"])})


@pytest.mark.parametrize("text", [
    WHOLE[: len(WHOLE) // 2],
    json.dumps({"error": True, "reason": "busy"}),
    json.dumps({"hourly": air(["2024-01-01T00:00", "2024-01-01T01:00"], dust=[7])}),
    json.dumps({"hourly": {k: v for k, v in air(["2024-01-01T00:00"]).items() if k != "ozone"}}),
])
def test_payloads_that_are_not_whole_are_refused(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    payload = read_landing(spark, str(tmp_path), "airquality")
    with pytest.raises(Exception, match="payload refused"):
        explode_hourly(payload, "airquality").collect()
    with pytest.raises(Exception, match="payload refused"):
        explode_hourly(payload, "airquality").count()


def test_newest_delivery_counts(spark, tmp_path):
    for name, value, age in (("b.json", 1.0, 100), ("a.json", 9.0, 50)):
        land(tmp_path / name, air(["2024-01-01T00:00"], dust=[value]))
        os.utime(tmp_path / name, (1_700_000_000 - age,) * 2)
    landed = read_landing(spark, str(tmp_path), "airquality", delivery=True)
    assert column(hourly_table(newest_delivery(landed), "airquality"), "DUST") == [9.0]
    rows = hourly_table(landed, "airquality", (DELIVERY,), position=True)
    assert column(newest_per_hour(rows), "DUST") == [9.0]
    assert newest_delivery(landed.limit(0)).count() == 0


def test_history_reads_only_requested_dates(spark, tmp_path):
    for day in ("2022-08-31", "2022-09-01", "2024-01-04", "2024-01-05", "2024-01-06"):
        land(tmp_path / f"obs_date={day}" / "a.json", air([f"{day}T00:00"]))
    weather = read_landing(spark, str(tmp_path), "airquality", at(24 * 4 + 0.3))
    days = column(hourly_table(weather, "airquality"), "OBSERVATION_TIME")
    assert [d.date().isoformat() for d in days] == ["2022-09-01", "2024-01-04"]
    plan = weather._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_date" in plan


def test_round_trip_by_station(spark, tmp_path):
    rows = [{"h": h, "station": s, "TEMPERATURE": h} for s in "ab" for h in range(30)]
    original = table(spark, "weather", rows, ("station",))
    from pyspark.sql import functions as F

    day = F.to_date("OBSERVATION_TIME").alias("obs_date")
    packed = to_payload(original, "weather", [F.col("station"), day])
    assert packed.count() == 4
    packed.write.partitionBy("obs_date").json(str(tmp_path / "w"))
    back = hourly_table(
        read_landing(spark, str(tmp_path / "w"), "weather", at(500), series=("station",)),
        "weather", ("station",),
    )
    assert back.exceptAll(original).count() == 0 and original.exceptAll(back).count() == 0
