"""The blocked window equals the plain one."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from airmart.operators import windows
from airmart.operators.windows import blocked, with_windows

FEATURES = {
    "LAG1": lambda w: F.lag("v", 1).over(w),
    "LAG2": lambda w: F.lag("v", 2).over(w),
    "ROLL": lambda w: F.sum("v").over(w.rowsBetween(-24, 0)),
    "NEXT": lambda w: F.lead("v", 1).over(w),
}


def frame(spark, rows):
    return spark.createDataFrame(rows, "s string, t int, v int")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def both(df, series, rows_per_block, num_partitions):
    plain = with_windows(df, FEATURES, ["t"], series, 24, 1, strategy="series")
    cut = blocked(df, FEATURES, ["t"], series, 24, 1, rows_per_block, num_partitions)
    return plain, cut


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    sizes=st.lists(st.integers(0, 90), min_size=1, max_size=5),
    rows_per_block=st.integers(25, 60),
    partitions=st.integers(1, 12),
    seed=st.integers(0, 1000),
)
def test_equals_plain_window(spark, sizes, rows_per_block, partitions, seed):
    rng = random.Random(seed)
    rows = [
        (None if i == 3 else f"s{i}", rng.choice([None, *range(60)]), rng.choice([None, *range(9)]))
        for i, n in enumerate(sizes) for _ in range(n)
    ]
    rng.shuffle(rows)
    df = frame(spark, rows)
    for series in ((), ("s",)):
        assert same(*both(df, series, rows_per_block, partitions))


def test_hot_series(spark):
    """One series holds most rows, and most of its rows share one time."""
    rows = [("hot", 7, i % 5) for i in range(700)] + [("hot", i, i) for i in range(100)]
    rows += [(f"s{i}", i, i) for i in range(200)]
    df = frame(spark, rows)
    assert same(*both(df, ("s",), 50, 8))
    assert same(*both(df, (), 50, 8))


def test_no_group_exceeds_the_block_size(spark):
    """Largest window group stays at block size plus halo, hot series or not."""
    df = frame(spark, [("hot", i, i) for i in range(1000)] + [("b", i, i) for i in range(30)])
    sizes = {"GROUP": lambda w: F.count(F.lit(1)).over(
        w.rowsBetween(windows.Window.unboundedPreceding, windows.Window.unboundedFollowing))}
    biggest = blocked(df, sizes, ["t"], ("s",), 24, 1, 50, 8).agg(F.max("GROUP")).first()[0]
    assert biggest <= 50 + 25


def test_blocks_are_the_default_and_nothing_switches(spark):
    df = frame(spark, [("hot", i, i) for i in range(300)] + [(None, i, i) for i in range(310)] + [("b", 1, 1)])
    for series in (("s",), ()):
        expected = with_windows(df, FEATURES, ["t"], series, 24, 1, strategy="series")
        assert same(with_windows(df, FEATURES, ["t"], series, 24, 1, rows_per_block=40), expected)
    with pytest.raises(ValueError):
        with_windows(df, FEATURES, ["t"], strategy="auto")


def test_block_must_cover_the_frame(spark):
    with pytest.raises(ValueError):
        blocked(frame(spark, [("a", 1, 1)]), FEATURES, ["t"], (), 24, 1, rows_per_block=24)


def test_empty_input(spark):
    df = frame(spark, [])
    for series in ((), ("s",)):
        plain, cut = both(df, series, 30, 4)
        assert cut.count() == 0 and cut.columns == plain.columns


def test_identical_rows_spread_over_the_ranges(spark):
    """A third of the rows are copies of one row; no range partition may take them all."""
    copies = frame(spark, [("a", 5, 5)] * 600).repartition(8)
    others = frame(spark, [("a", i % 50, i) for i in range(1200)]).repartition(8)
    df = copies.unionByName(others)
    assert same(*both(df, ("s",), 60, 8))
    tagged = df.withColumn("_task", F.spark_partition_id())
    ranged = tagged.repartitionByRange(8, "s", "t", "v", "_task")
    sizes = ranged.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 600


@pytest.mark.parametrize("block, span", [(1, 5), (3, 5), (4, 0), (1000, 5)])
def test_frames_by_time_equal_the_plain_window(spark, block, span):
    import random
    from datetime import timedelta

    from pyspark.sql import Window

    from airmart.operators.windows import blocked_by_time
    from tests.helpers import at

    rng = random.Random(block)
    rows = [(rng.choice("aab"), at(rng.choice(range(60)) / 2), rng.uniform(0, 9)) for _ in range(70)] + [("a", None, 1.0), ("c", None, 2.0), (None, at(3), 3.0), (None, at(4), 5.0)]
    df = spark.createDataFrame(rows, "station string, t timestamp_ntz, v double").repartition(4)
    back, forth, hour = timedelta(hours=span), timedelta(hours=2), timedelta(hours=1)
    features = {
        "m": lambda frame: F.round(F.avg("v").over(frame(-back, timedelta(0))), 6), "n": lambda frame: F.count("v").over(frame(-back, forth)),
        "next": lambda frame: F.max("v").over(frame(hour, hour)),
    }
    got = blocked_by_time(df, features, "t", ("station",), back, forth, rows_per_block=block)
    micros = F.unix_micros(F.col("t").cast("timestamp"))
    window = lambda a, b: Window.partitionBy("station").orderBy(micros).rangeBetween(int(a.total_seconds() * 1e6), int(b.total_seconds() * 1e6))
    known = F.col("t").isNotNull()
    want = df.select("*", *[F.when(known, make(window)).alias(name) for name, make in features.items()])
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == len(rows)
