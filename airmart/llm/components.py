"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airmart.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the links (a, b).

    Each round maps every node to the least of itself and its neighbours and
    keeps the links between different nodes. Rounds take the least by id, which
    collapses stars around small ids, and by a hash that changes, in turn; the
    latter leaves a share of the nodes of any chain, so the number of rounds grows
    with the logarithm of the nodes. Rounds are written, so nothing but their
    number passes the driver. Links with a null end are left out.
    """
    links = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = nodes.select("node", F.col("node").alias("root"))
    number = 0
    while not links.isEmpty():
        def rank(c: str):
            return F.struct((F.xxhash64(c, F.lit(number)) if number % 2 else F.lit(0).cast("long")).alias("h"), F.col(c).alias("node"))

        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(rank("b")).alias("low")).select("a", F.least(rank("a"), F.col("low")).getField("node").alias("to"))
        least = materialize(least, "least")
        of_b = least.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        moved = links.join(least, "a").join(of_b, "b").select(F.col("to").alias("a"), F.col("to_b").alias("b"))
        of_root = least.select(F.col("a").alias("root"), "to")
        labels = labels.join(of_root, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = materialize(labels, "labels")
        links = materialize(moved.where("a <> b").distinct(), "links")
        number += 1
    smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(smallest, "root").select("node", "component")
