"""Approximate nearest neighbours with a permutation index.

Pivots are `n_pivots` vectors, drawn from the `sample` vectors lowest by hash so
that each is far from those before it. A vector is represented by its nearest
pivots in order; its posting (id, order, vector) lies in the inverted files of
the nearest `posted` ones. A query opens the files of its nearest `probed` pivots
and ranks their postings by footrule distance, the sum of the differences in
position of the query's pivots (a pivot missing in a posting's order counts as
one place after its end). The best `reranked` share of each file
(`at_least` so many) is ranked anew by exact Euclidean distance in double precision.

A file is cut into blocks of about `block_rows` postings by hash of the id, and
the queries that open it into blocks of about `block_queries`; a pair of blocks
is one group, so no group grows with the data. Sizes are taken from one count per
pivot. Every row is indexed; only pivots come from a sample.

Vectors that are null, of another size than most, zero, or hold null or
non-finite components take no part. Rows with a null id take no part. Rows that
share an id count as one item, as near as the nearest of them. A query finds
no row of its own id; ties go to the smaller id. With fewer candidates than `k`,
all found are returned. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

N_PIVOTS, SAMPLE, ORDER = 64, 4096, 64
POSTED, PROBED = 4, 16
RERANKED_SHARE, RERANKED_LEAST = 0.25, 200
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 2_048


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, vector as doubles) that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where("id is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (size[0].n if size else 0))


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """Rows of `vectors`, each the farthest from those chosen before; equal rows are chosen once."""
    chosen, far = [0], None
    while len(chosen) < n:
        last = ((vectors - vectors[chosen[-1]]) ** 2).sum(1)
        far = last if far is None else np.minimum(far, last)
        if far.max() == 0:
            break
        chosen.append(int(far.argmax()))
    return vectors[chosen]


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Nearest pivots of each vector, nearest first."""
    near = (pivots * pivots).sum(1) - 2 * vectors @ pivots.T
    return np.argsort(near, 1, kind="stable")[:, :length].astype(np.int16)


def search(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, n_pivots: int = N_PIVOTS,
    sample: int = SAMPLE, length: int = ORDER, posted: int = POSTED, probed: int = PROBED, reranked: float = RERANKED_SHARE, at_least: int = RERANKED_LEAST,
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for the rows where `is_query`, a condition on the id column."""
    rows = usable(df, id_col, vector_col)
    drawn = [r.vector for r in rows.orderBy(F.xxhash64("vector"), "id").limit(sample).select("vector").collect()]
    spark = df.sparkSession
    result = "query_id long, vec_id long, score double"
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = choose_pivots(np.array(drawn), n_pivots)

    def post(batches):
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(len(batch), -1)
            own = orders(vectors, pivots, length)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("is_query"), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([o.tobytes() for o in own], pa.binary()),
                 pa.array(own.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                ["id", "is_query", "vector", "order", "near"],
            )

    flagged = usable_flag(rows, is_query, id_col)
    ordered = flagged.mapInArrow(post, "id long, is_query boolean, vector binary, order binary, near array<int>")
    items = ordered.select("id", "vector", "order", F.explode(F.slice("near", 1, posted)).alias("pivot"))
    queries = ordered.where("is_query").select("id", "vector", "order", F.explode(F.slice("near", 1, probed)).alias("pivot"))
    # How many blocks each file and its queries are cut into; one row per pivot.
    n_items = {r.pivot: r["count"] for r in items.groupBy("pivot").count().collect()}
    n_queries = {r.pivot: r["count"] for r in queries.groupBy("pivot").count().collect()}
    blocks = [(p, -(-n // block_rows), -(-n_queries[p] // block_queries)) for p, n in n_items.items() if p in n_queries]
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = F.broadcast(spark.createDataFrame(blocks, "pivot int, item_blocks int, query_blocks int"))
    keys = ["pivot", "item_block", "query_block"]
    item_groups = items.join(sizes, "pivot").withColumn("item_block", F.pmod(F.xxhash64("id"), "item_blocks").cast("int")).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))).select(*keys, "id", "vector", "order")
    query_groups = queries.join(sizes, "pivot").withColumn("query_block", F.pmod(F.xxhash64("id"), "query_blocks").cast("int")).withColumn(
        "item_block", F.explode(F.sequence(F.lit(0), F.col("item_blocks") - 1)))
    query_groups = query_groups.select(*(F.col(c).alias(f"query_{c}") for c in (*keys, "id", "vector", "order")))

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        return file_search(left, right, len(pivots), k, reranked, at_least)

    found = item_groups.groupBy(*keys).cogroup(query_groups.groupBy(*(f"query_{c}" for c in keys))).applyInArrow(nearest, result)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def usable_flag(rows: DataFrame, is_query: Column, id_col: str) -> DataFrame:
    """Marks queries by a condition that names the id by its original column."""
    named = rows if id_col == "id" else rows.withColumn(id_col, F.col("id"))
    return named.withColumn("is_query", F.coalesce(is_query, F.lit(False))).select("id", "vector", "is_query")


def matrix(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind).reshape(len(table), -1)


def file_search(items: pa.Table, queries: pa.Table, n_pivots: int, k: int, reranked: float, at_least: int) -> pa.Table:
    """Nearest postings of one block for each query of one block."""
    names = ["query_id", "vec_id", "score"]
    if not len(items) or not len(queries):
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    items = items.sort_by("id")
    ids, vectors, own = items.column("id").to_numpy(), matrix(items, "vector", np.float64), matrix(items, "order", np.int16)
    place = np.full((n_pivots, len(ids)), own.shape[1], np.int16)
    place[own, np.arange(len(ids))[:, None]] = np.arange(own.shape[1], dtype=np.int16)
    found, most = [], max(at_least, k + 1, int(reranked * len(ids)))
    for query, vector, order in zip(queries.column("query_id").to_pylist(), matrix(queries, "query_vector", np.float64), matrix(queries, "query_order", np.int16)):
        footrule = np.zeros(len(ids), np.int64)
        for position, pivot in enumerate(order):
            footrule += np.abs(place[pivot] - np.int16(position))
        ranked = footrule * len(ids) + np.arange(len(ids))  # ties to the smaller id
        ranked[ids == query] = np.iinfo(np.int64).max
        best = np.argpartition(ranked, most)[:most] if len(ids) > most else np.arange(len(ids))
        best = best[ids[best] != query]
        exact = np.sqrt(((vectors[best] - vector) ** 2).sum(1))
        top = np.lexsort((ids[best], exact))[:k]
        found.append((np.full(len(top), query), ids[best[top]], exact[top]))
    return pa.table(dict(zip(names, map(np.concatenate, zip(*found)))))
