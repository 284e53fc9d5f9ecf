"""Rows numbered in a total order, by series, without one task that sees a whole series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from airmart.session import materialize

_ROW_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def number(df: DataFrame, series: str, order: list[str]) -> DataFrame:
    """`df` with `index`, its place in its series (from 0), and `n`, the rows of the series.

    Rows go to range partitions by (series, order) and are written there once, so
    that places and counts come from the same data; a long series covers many
    partitions. Their sizes, one row for each partition and series in it, give the
    places. Rows that tie in all of `order` are placed in no fixed order, and spread
    over the partitions all the same. `df` runs twice (ranges are sampled), so pass
    a written table. Nulls come first.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [series, *order, "_task"]
    tagged = df.withColumn("_task", F.spark_partition_id())
    placed = tagged.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_task")
    staged = materialize(placed.withColumn("_pos", F.monotonically_increasing_id()), "ordered")
    staged = staged.withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    runs = staged.groupBy(series, "_part").agg(F.count("*").alias("_size"), F.min("_pos").alias("_first"))
    own = Window.partitionBy(series)
    before = F.coalesce(F.sum("_size").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select(series, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_size").over(own).alias("n"))
    return staged.join(starts, [series, "_part"]).select(*df.columns, (F.col("_pos") + F.col("_shift")).alias("index"), "n")
