"""Row-frame windows over long series.

A window without a partition key, or with one hot key, sends all its rows to
one task. Frames that reach a known number of rows back and forth do not need
that: ``blocked`` cuts the global order into blocks of equal row count, copies
the few rows a neighbouring block's frames reach, and evaluates each block on
its own with the same result. ``blocked_by_time`` does so for frames that reach a
span of time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from airmart.session import materialize

Features = dict[str, Callable[[WindowSpec], Column]]

ROWS_PER_BLOCK = 100_000
_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def total_order(df: DataFrame, order: list[str], series: tuple[str, ...] = ()) -> list[Column]:
    """``order`` followed by every other column, so only equal rows can tie."""
    rest = [c for c in df.columns if c not in (*order, *series)]
    return [F.col(c).asc_nulls_last() for c in (*order, *rest)]


def with_windows(
    df: DataFrame,
    features: Features,
    order: list[str],
    series: tuple[str, ...] = (),
    preceding: int = 0,
    following: int = 0,
    strategy: str = "blocked",
    **blocks: int | None,
) -> DataFrame:
    """``df`` plus one column per feature, windowed by series in ``order``.

    ``preceding`` and ``following`` bound the rows any frame reaches.
    ``blocked`` never builds a group above its block size, whatever the length
    of a series. ``series`` runs one window partition per series, without the
    extra shuffle; choose it only where every series is known to be short.
    """
    if strategy == "series":
        window = Window.partitionBy(*series).orderBy(*total_order(df, order, series))
        return df.select("*", *[make(window).alias(name) for name, make in features.items()])
    if strategy == "blocked":
        return blocked(df, features, order, series, preceding, following, **blocks)
    raise ValueError(f"unknown window strategy {strategy!r}")


def numbered(
    df: DataFrame,
    order: list[str],
    series: tuple[str, ...] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``_row``, its place in the global order of series and ``order``, written once."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # Ids and counts come from the same data. Only identical rows tie; the task they come
    # from spreads even those over the ranges.
    keys = [*[F.col(s).asc_nulls_last() for s in series], *total_order(df, order, series)]
    tagged = df.withColumn("_task", F.spark_partition_id())
    ordered = tagged.repartitionByRange(n, *keys, "_task").sortWithinPartitions(*keys, "_task")
    staged = materialize(ordered.drop("_task").withColumn("_pos", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_pos", _POSITION_BITS)

    # One row per range partition, so at most n rows: safe in one task and to broadcast.
    sizes = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))

    local = F.col("_pos").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    rows = staged.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return rows.select(*df.columns, (F.col("_start") + local).alias("_row"))


def blocked(
    df: DataFrame,
    features: Features,
    order: list[str],
    series: tuple[str, ...] = (),
    preceding: int = 0,
    following: int = 0,
    rows_per_block: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact row-frame windows with no group above ``rows_per_block`` plus halo."""
    rows_per_block = rows_per_block or ROWS_PER_BLOCK
    if rows_per_block < max(1, preceding + following):
        raise ValueError("rows_per_block must cover preceding + following")
    columns = df.columns
    rows = numbered(df, order, series, num_partitions)

    # Each row goes to every block holding a row whose frame can reach it: two at most.
    first = F.expr(f"greatest(_row - {following}, 0L) div {rows_per_block}")
    last = F.expr(f"(_row + {preceding}) div {rows_per_block}")
    copies = rows.select(*columns, "_row", F.explode(F.sequence(first, last)).alias("_block"))

    window = Window.partitionBy("_block", *series).orderBy("_row")
    own = F.col("_block") == F.expr(f"_row div {rows_per_block}")
    return (
        copies.select("*", *[make(window).alias(name) for name, make in features.items()])
        .where(own)
        .select(*columns, *features)
    )


def _reached(edges: DataFrame, backwards: bool, span: int) -> DataFrame:
    """(key, _to, _block, limit): blocks that hold rows within ``span`` of the edge of another, and up to what time.

    Edges of a series in order of time, a block's own beside those of the blocks it may
    reach; in that order blocks within reach are neighbours. A long series has one edge
    for each of its blocks here.
    """
    own, other = ("first", "last") if backwards else ("last", "first")
    nothing = F.lit(None).cast("long")

    def of(which: str, to, block) -> DataFrame:
        return edges.select(F.col(f"{which}.key").alias("key"), F.col(f"{which}._at").alias("at"), to.alias("_to"), block.alias("from"))

    both = of(own, F.col("_block"), nothing).union(of(other, nothing, F.col("_block")))
    window = Window.partitionBy("key").orderBy("at").rangeBetween(-span if backwards else 0, 0 if backwards else span)
    least, most = F.min("from").over(window), F.max("from").over(window)
    found = both.select("key", "at", "_to", least.alias("least"), most.alias("most")).where("_to IS NOT NULL")
    if backwards:
        pairs = found.where("least < _to").withColumn("_block", F.explode(F.sequence("least", F.col("_to") - 1)))
        return pairs.select("key", "_to", "_block", (F.col("at") - span).alias("limit"))
    pairs = found.where("most > _to").withColumn("_block", F.explode(F.sequence(F.col("_to") + 1, F.col("most"))))
    return pairs.select("key", "_to", "_block", (F.col("at") + span).alias("limit"))


TimeFeatures = dict[str, Callable[[Callable[[timedelta, timedelta], WindowSpec]], Column]]


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def blocked_by_time(
    df: DataFrame,
    features: TimeFeatures,
    time: str,
    series: tuple[str, ...] = (),
    preceding: timedelta = timedelta(0),
    following: timedelta = timedelta(0),
    rows_per_block: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact windows whose frames reach a span of time instead of a number of rows.

    A feature gets a function that makes a frame from one offset to another, such as
    ``frame(-timedelta(hours=24), timedelta(0))``; offsets lie within ``preceding`` and
    ``following``. Blocks are cut by row, so that each holds as many. A block then gets
    copies of rows of its neighbours by their distance in time: of the series that it
    begins with, those up to ``preceding`` before its first row, and of the one that it
    ends with, those up to ``following`` after its last. Rows without a time are in no
    frame and see none.
    """
    rows_per_block = rows_per_block or ROWS_PER_BLOCK
    columns = df.columns
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = numbered(df, [time], series, num_partitions)
    rows = materialize(rows.withColumns({"_at": at, "_block": F.expr(f"_row div {rows_per_block}")}), "numbered")

    # One row per block: the first and the last row that has a time.
    key = F.struct(*[F.col(s) for s in series], F.lit(0).alias("_one"))
    edge = F.struct("_row", key.alias("key"), "_at")
    edges = rows.where("_at IS NOT NULL").groupBy("_block").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    whole = [*columns, "_row", "_at"]
    copies = rows.select(*whole, F.col("_block").alias("_to"), "_block")
    for backwards, span in ((True, micros(preceding)), (False, micros(following))):
        # Even frames that end at the row itself reach rows of the same time in the next block.
        pairs = _reached(edges, backwards, span)
        near = (F.col("_at") >= F.col("limit")) if backwards else (F.col("_at") <= F.col("limit"))
        extra = rows.withColumn("key", key).join(pairs, ["key", "_block"]).where(near)
        copies = copies.unionByName(extra.select(*whole, "_to", "_block"))

    def frame(start: timedelta, end: timedelta) -> WindowSpec:
        return Window.partitionBy("_to", *series).orderBy("_at").rangeBetween(micros(start), micros(end))

    known = F.col("_at").isNotNull()
    made = [F.when(known, make(frame)).alias(name) for name, make in features.items()]
    return copies.select("*", *made).where("_to = _block").select(*columns, *features)
