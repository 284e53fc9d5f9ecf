"""Physical plans: what must and must not appear."""

import re

import pytest
from pyspark.sql import functions as F

from airmart.functions import calendar_parts
from airmart.operators.dedup import unite
from airmart.operators.latest import latest_rows
from airmart.operators.store import VersionedStore
from airmart.plans import marts
from airmart.session import materialize
from airmart.sources import sensors
from workload import runs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf01):
    """Station tables as written Parquet, as a run would find them."""
    f = sensors.station_feeds(sensors.read_events(spark, sf01))
    return [materialize(t) for t in (f.weather_history, f.air_history, f.weather_now, f.air_now)]


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


STATION = ("station",)


def test_blocked_training_never_gathers_a_series(tables):
    """Only the table of partition sizes, one row per partition, may meet in one task."""
    for series in ((), STATION):
        mart = marts.classifier_training(*tables[:2], series, strategy="blocked")
        singles = re.findall(r"Exchange SinglePartition.*", plan(mart))
        text = plan(mart)
        assert len(singles) == 1
        after = text[text.index("Exchange SinglePartition"):].splitlines()[1]
        assert "_part" in after and "count" in after


def test_joins_are_hash_joins_without_products(tables):
    for df in (
        marts.fact_hourly(unite(tables[0], tables[2], series=STATION),
                          unite(tables[1], tables[3], series=STATION), STATION),
        marts.anomaly_rows(tables[0], tables[1], STATION),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_fact_shuffles_each_side_once(tables):
    """Dedup and join share one partitioning."""
    fact = marts.fact_hourly(
        unite(tables[0], tables[2], series=STATION), unite(tables[1], tables[3], series=STATION),
        STATION,
    )
    assert plan(fact).count("Exchange hashpartitioning") == 2
    assert plan(fact).count("WindowGroupLimit") == 4  # partial and final on each side


def test_latest_rows_limit_before_the_shuffle(tables):
    per_station = latest_rows(tables[0], 48, ["OBSERVATION_TIME"], STATION)
    text = plan(per_station)
    assert text.count("Partial, ") + text.count(", Partial") >= 1 and "WindowGroupLimit" in text
    assert "TakeOrderedAndProject" in plan(latest_rows(tables[0], 48, ["OBSERVATION_TIME"]))


def test_latest_rows_are_shuffled_once(tables):
    """Map tasks keep k rows of a series already; only a large k is ranked in slices first."""
    ranked = lambda k: plan(latest_rows(tables[0], k, ["OBSERVATION_TIME"], STATION)).count("Exchange hashpartitioning")
    assert ranked(48) == 1 and ranked(5000) == 2


def test_calendar_names_need_no_formatter(spark):
    days = spark.sql("SELECT explode(sequence(timestamp_ntz'2023-12-30', timestamp_ntz'2025-01-03', interval 9 hours)) AS t UNION ALL SELECT NULL")
    names = calendar_parts(F.col("t"))
    wrong = days.select("t", names["MONTH_NAME"].alias("m"), names["DAY_NAME"].alias("d")).where("NOT (m <=> monthname(t) AND d <=> dayname(t))")
    assert wrong.count() == 0
    assert "monthname" not in plan(days.select(*names.values())) and "dayname" not in plan(days.select(*names.values()))


def test_gate_runs_aggregate_events_once(spark, sf001, monkeypatch):
    class Seen(Exception):
        pass

    def stop(store, tables):
        raise Seen([plan(rows) for rows in tables.values()])

    monkeypatch.setattr(VersionedStore, "refresh_together", stop)
    with pytest.raises(Seen) as found:
        runs.dq_gate(spark, sf001)
    assert found.value.args[0] and not any("Aggregate" in p for p in found.value.args[0])


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(marts.anomaly_rows(tables[0], tables[1], STATION))
    assert "IsNotNull(PM2_5)" in text
    assert "SOLAR_RADIATION" not in text and "OZONE" not in text


def test_no_python_in_any_plan(spark, sf01, tables):
    frames = [
        marts.classifier_training(*tables[:2], STATION, strategy="blocked"),
        marts.classifier_inference(*tables, STATION),
        marts.fact_hourly(tables[0], tables[1], STATION),
    ]
    for df in frames:
        assert "Python" not in plan(df) and "Pandas" not in plan(df)
