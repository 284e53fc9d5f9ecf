"""Runs that write changed days only give what a run over everything gives."""

import random

import pytest
from pyspark.sql import functions as F

from airmart import schemas as S
from airmart.operators import days as D
from airmart.plans.refresh import HISTORY_TABLES, Options, Refresh
from airmart.sources.landing import plan_load
from tests.helpers import at
from tests.test_refresh import payload

TABLES = [*HISTORY_TABLES.values(), "common_hours", "anomaly_training", "classifier_training", "fact_hourly", "stg_weather"]


def land(root, kind, day, hours, name):
    folder = root / f"{kind}_history" / f"obs_date={at(24 * day).date()}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(payload(kind, hours))


def load(run):
    for kind in S.FIELDS:
        run.load_history(kind)
    run.load_realtime()
    run.release()


@pytest.mark.parametrize("time_based", [False, True])
def test_late_changed_and_lost_deliveries(spark, tmp_path, time_based):
    """Each delivery is compared with a run over the same landing into an empty store."""
    landing, rng = tmp_path / "landing", random.Random(7)
    options = Options(time_based=time_based, rows_per_block=40)
    for kind in S.FIELDS:
        (landing / f"{kind}_realtime").mkdir(parents=True)
        (landing / f"{kind}_realtime" / "a.json").write_text(payload(kind, range(24 * 9, 24 * 9 + 20)))
        for day in range(9):
            land(landing, kind, day, [24 * day + h for h in range(24) if rng.random() < 0.7], "a.json")
    land(landing, "weather", 4, [], "a.json")  # a day without hours
    steps = [
        (24 * 9 + 0.5, lambda: None),
        (24 * 9 + 1.5, lambda: land(landing, "airquality", 2, range(48, 60), "b.json")),
        (24 * 9 + 1.5, lambda: land(landing, "weather", 4, [95, 96, 97, 120], "c.json")),  # hours of its neighbours too
        (24 * 9 + 1.5, lambda: (landing / "airquality_history" / f"obs_date={at(24 * 6).date()}" / "a.json").unlink()),
        (24 * 9 + 3.5, lambda: land(landing, "weather", 9, [24 * 9, 24 * 9 + 1, 24 * 9 + 2, 24 * 9 + 9], "a.json")),
    ]
    for number, (hour, change) in enumerate(steps[: 3 if time_based else 5]):
        change()
        run = Refresh(spark, str(landing), str(tmp_path / "store"), at(hour), options)
        before = run.store.snapshot()
        load(run)
        whole = Refresh(spark, str(landing), str(tmp_path / f"whole{number}"), at(hour), options)
        load(whole)
        after = run.store.snapshot()
        for table in TABLES:
            a, b = after.read(table), whole.store.read(table)
            if "PM25_ROLL24" in a.columns:
                a, b = (x.withColumn("PM25_ROLL24", F.round("PM25_ROLL24", 6)) for x in (a, b))
            assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, (number, table)
        if number:
            written = {t: len({p.day for p in after.table(t).parts} - {p.day for p in before.table(t).parts if p in after.table(t).parts}) for t in TABLES}
            assert written["raw_weather_history"] + written["raw_airquality_history"] <= 4
            assert written["classifier_training"] < len(after.table("classifier_training").parts)


def test_bytes_written_grow_with_changed_days(spark, tmp_path):
    landing = tmp_path / "landing"
    for kind in S.FIELDS:
        (landing / f"{kind}_realtime").mkdir(parents=True)
        (landing / f"{kind}_realtime" / "a.json").write_text(payload(kind, [0]))
        for day in range(20):
            land(landing, kind, day, range(24 * day, 24 * day + 24), "a.json")

    def fresh(days):
        for day in days:
            land(landing, "weather", day, range(24 * day, 24 * day + 24), "b.json")
        before = {t: set(x.parts) for t, x in run.store.snapshot().tables.items()}
        run.load_history("weather")
        run.build_history()
        after = run.store.snapshot().tables
        return {t: sum(p.bytes for p in after[t].parts if p not in before[t]) for t in ("raw_weather_history", "common_hours", "classifier_training")}

    run = Refresh(spark, str(landing), str(tmp_path / "store"), at(24 * 20))
    load(run)
    run.build_history()
    assert set(fresh([]).values()) == {0}
    one, eight = fresh([3]), fresh([2, 4, 6, 8, 10, 12, 14, 16])
    for table in one:
        assert 0 < one[table] < eight[table]
    assert eight["raw_weather_history"] == pytest.approx(8 * one["raw_weather_history"], rel=0.2)


def test_days_near_a_change(spark):
    rows = [("a", d, n) for d, n in (("2024-01-01", 20), ("2024-01-02", 5), ("2024-01-03", 20), ("2024-01-05", 20), ("2024-01-06", 1))]
    rows += [("b", "2024-01-01", 1), ("b", "2024-01-04", 1), ("b", "2024-01-09", 30)]
    counts = spark.createDataFrame(rows, "station string, _day string, n long")
    near = lambda days, ahead, behind: D.near_days(counts, days, ahead, behind, ("station",))
    assert near(["2024-01-02"], 24, 1) == {"2024-01-01", "2024-01-03", "2024-01-05", "2024-01-04", "2024-01-09"}
    assert near(["2024-01-04"], 1, 0) == {"2024-01-05", "2024-01-09"}
    assert near(["2024-01-09"], 24, 24) == {"2024-01-06", "2024-01-05", "2024-01-03", "2024-01-04", "2024-01-01"}
    assert near([], 24, 1) == set()


def test_plan_reads_only_what_changed():
    spans = {"2024-01-01": ("2024-01-01", "2024-01-02"), "2024-01-02": ("2024-01-02", "2024-01-02"), "2024-01-05": ("2024-01-05", "2024-01-05")}
    ask = lambda days: {d: spans[d] for d in days}
    marks = {d: "m" for d in spans}
    first = plan_load(marks, ask, {}, at(200), ())
    assert first.days is None and first.folders == set(spans)
    again = plan_load(marks, ask, first.notes, at(200), ())
    assert again.nothing
    changed = plan_load(marks | {"2024-01-02": "n"}, ask, first.notes, at(200), ())
    assert changed.days == {"2024-01-02"} and changed.folders == {"2024-01-01", "2024-01-02"}
    gone = plan_load({d: "m" for d in list(spans)[1:]}, ask, first.notes, at(200), ())
    assert gone.days == {"2024-01-01", "2024-01-02"} and gone.folders == {"2024-01-02"}
    other = plan_load(marks, ask, first.notes, at(200), ("station",))
    assert other.days is None
    moved = plan_load(marks, ask, plan_load(marks, ask, {}, at(24 * 4 + 3), ()).notes, at(24 * 4 + 5), ())
    assert moved.days == {"2024-01-05"}
