"""Join of documents whose sets of word shingles are similar (Jaccard).

A document's set holds the distinct hashes of its word shingles (see words.py).
Two documents link when `percent` per cent of the union of their sets, or more,
is shared. The join finds all links, the number of each document's links and the
classes of documents that links connect:

1. Equal sets are one class at once, represented by its smallest id.
2. A set can only link if that share of its shingles occurs in other sets as
   well. `shared_shingles` deals packed shingle hashes out to buckets by hash
   range, and each bucket tells every batch of documents which of its hashes
   occur twice, and how often. Sets with too few such shingles leave. This runs
   over all texts, and again over the distinct sets that are left.
3. Similar sets have a shingle of their rarest-first prefixes in common. Sets that
   share one, directly or by way of others, are a family, so that every set is
   in one family only. A family is searched by T-occurrence (DivideSkip) in an
   inverted index: of the lists of a set's shingles the longest are put aside, the
   short ones merged by a heap, and candidates that occur often enough are probed in
   the long lists by binary search. Whoever reaches the required overlap is a link, so
   every pair of similar distinct sets gives one. Families beyond `block_sets`
   sets are split into parts, and each pair of parts is searched as one block.
4. A block counts the links of each of its sets, each with the documents of the set
   it leads to, and names one set that each is connected with. So no more than a row
   for each set leaves a block, however many pairs link. Counts are added up, and
   connections contracted to classes.

Shingle hashes keep `KEPT_BITS` bits in step 2 and 3, and sets are compared by them.

A null or empty text has an empty set, links with nothing and is its own class.
Repeated rows are equal sets. Rows that share an id are one document of that id.
A null id takes the class of its equals, and is null if there is none with an
id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from airmart.llm.components import components
from airmart.llm.segments import slices
from airmart.llm.words import blocks, mixed, shingles
from airmart.session import materialize

WIDTH, PERCENT = 5, 80
BUCKET_BITS, KEPT_BITS = 10, 50
BLOCK_SETS = 2048
WAYS = 16
MERGE_COST = 0.0085  # of DivideSkip: a probe of a long list against a step of the merge


def text_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, words in blocks(texts):
        for k in range(len(words.off) - 1):
            yield np.unique(shingles(words.text(k), width))


def signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return tuple(int(x) for x in np.array([mixed(own).sum(), mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64).view(np.int64)) if len(own) else (0, 0)


SIGNED = "id long, key long, n_shingles long, s0 long, s1 long"


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, key, n_shingles, s0, s1) of each row of (id, key, text)."""
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(own), *signature(own)) for own in text_sets(batch.column("text"), width)]
            columns = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), *map(pa.array, columns.T)], [x.split()[0] for x in SIGNED.split(", ")])

    return docs.mapInArrow(signed, SIGNED)


def required(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shared shingles that any set similar to one of n has with it, at least."""
    return -(-n * percent // 100)


PACKED = "batch string, bucket int, docs binary, shingles binary"


if BUCKET_BITS < 0 or (KEPT_BITS - BUCKET_BITS) % 8:
    raise ValueError("the bits of a hash below its bucket's must be whole bytes")


def packed(batch: str, ids: np.ndarray, sizes: np.ndarray, keys: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
    """One row with the documents of a batch (bucket -1), and one for each bucket with its hashes and their documents."""
    flat = np.concatenate([np.zeros(0, np.uint64), *sets]).astype(np.uint64)
    owner = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
    low = KEPT_BITS - BUCKET_BITS
    bucket = (flat >> np.uint64(low)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    flat, owner, bucket = flat[order] & np.uint64((1 << low) - 1), owner[order], bucket[order]
    found, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(flat))
    short = np.ascontiguousarray(flat.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : low // 8])
    docs = [np.column_stack([ids, sizes, keys]).astype(np.int64).tobytes()] + [owner[a:b].tobytes() for a, b in zip(first, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array([batch] * (len(found) + 1)), pa.array(np.append(-1, found).astype(np.int32)), pa.array(docs, pa.binary()), pa.array([b""] + [short[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())],
        ["batch", "bucket", "docs", "shingles"],
    )


def unpacked(data: bytes, bucket: int) -> np.ndarray:
    width = (KEPT_BITS - BUCKET_BITS) // 8
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel() | np.uint64(bucket << (KEPT_BITS - BUCKET_BITS))


def text_postings(docs: DataFrame, width: int) -> DataFrame:
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                ids = batch.column("id").slice(at, len(texts))
                at += len(texts)
                first: dict[tuple[int, int, int], tuple] = {}
                for i, own in zip(ids.to_pylist(), text_sets(texts, width)):
                    key = (len(own), *signature(own))
                    if len(own) and i is not None and (key not in first or i < first[key][0]):
                        first[key] = (i, own >> np.uint64(64 - KEPT_BITS))
                if first:
                    keys = np.array(list(first), np.int64)
                    yield packed(f"{part}-{number}", np.array([i for i, _ in first.values()]), keys[:, 0], keys[:, 1:], [s for _, s in first.values()])
                    number += 1

    return docs.mapInArrow(post, PACKED)


def set_postings(sets: DataFrame) -> DataFrame:
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, len(batch), 2048):
                own = batch.slice(at, 2048)
                columns = [own.column(c).to_numpy() for c in ("id", "n", "s0", "s1")]
                yield packed(f"{part}-{number}", *columns[:2], np.column_stack(columns[2:]), [np.frombuffer(x, np.uint64) for x in own.column("shingles").to_pylist()])
                number += 1

    return sets.mapInArrow(post, PACKED)


SETS = "id long, n long, s0 long, s1 long, shingles binary, counts binary"


def shared_shingles(postings: DataFrame, percent: int) -> DataFrame:
    """Sets of which enough shingles occur in several sets: those shingles, sorted and how many sets have each."""
    def repeated(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        if bucket < 0:
            return group.append_column("counts", pa.array([b""] * len(group), pa.binary()))
        hashes = [unpacked(x, bucket) for x in group.column("shingles").to_pylist()]
        value, code, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        count = np.minimum(count, np.iinfo(np.uint32).max).astype(np.uint32)[code]
        ends = np.cumsum([len(h) for h in hashes])
        docs, kept, counts = [], [], []
        width = (KEPT_BITS - BUCKET_BITS) // 8
        for own, data, n in zip(group.column("docs").to_pylist(), group.column("shingles").to_pylist(), np.split(count, ends[:-1])):
            on = n > 1
            docs.append(np.frombuffer(own, np.uint32)[on].tobytes())
            kept.append(np.frombuffer(data, np.uint8).reshape(-1, width)[on].tobytes())
            counts.append(n[on].tobytes())
        return pa.table({"batch": group.column("batch"), "bucket": group.column("bucket"), "docs": pa.array(docs, pa.binary()), "shingles": pa.array(kept, pa.binary()), "counts": pa.array(counts, pa.binary())})

    def gathered(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("bucket").to_pylist(), group.column("docs").to_pylist(), group.column("shingles").to_pylist(), group.column("counts").to_pylist()))
        ids, size, s0, s1 = np.frombuffer(rows[0][1], np.int64).reshape(-1, 4).T
        owner = np.concatenate([np.zeros(0, np.uint32)] + [np.frombuffer(d, np.uint32) for _, d, _, _ in rows[1:]])
        flat = np.concatenate([np.zeros(0, np.uint64)] + [unpacked(s, b) for b, _, s, _ in rows[1:]])
        count = np.concatenate([np.zeros(0, np.uint32)] + [np.frombuffer(c, np.uint32) for *_, c in rows[1:]])
        order = np.argsort(owner, kind="stable")  # within a document hashes stay sorted, as buckets came in order
        flat, count = flat[order], count[order]
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=len(ids))))
        keep = [k for k in range(len(ids)) if ends[k + 1] - ends[k] >= max(1, required(int(size[k]), percent))]
        parts = [slice(ends[k], ends[k + 1]) for k in keep]
        columns = [x[keep] for x in (ids, size, s0, s1)]
        return pa.table(dict(zip(("id", "n", "s0", "s1", "shingles", "counts"), [
            *map(pa.array, columns), pa.array([flat[p].tobytes() for p in parts], pa.binary()), pa.array([count[p].tobytes() for p in parts], pa.binary())])))

    told = postings.groupBy("bucket", F.when(F.col("bucket") < 0, F.col("batch")).alias("own")).applyInArrow(repeated, PACKED + ", counts binary")
    return told.groupBy("batch").applyInArrow(gathered, SETS)


def heap_merged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values of sorted lists and in how many of them each occurs; a heap gives the shortest lists, `WAYS` of which are merged at a time."""
    heap = [(len(x), k, x) for k, x in enumerate(lists)]
    heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        shortest = [heappop(heap)[2] for _ in range(min(WAYS, len(heap)))]
        merged = np.concatenate(shortest)
        merged.sort(kind="stable")  # which merges runs that are in order
        heappush(heap, (len(merged), number, merged))
        number += 1
    merged = heap[0][2]
    first = np.flatnonzero(np.append(True, merged[1:] != merged[:-1]))
    return merged[first], np.diff(np.append(first, len(merged)))


def block_links(sets: list[np.ndarray], sizes: np.ndarray, percent: int, queries: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Links in a block, as places of a set and of those it links to: each link once, or all from `queries` to other sets; a T-occurrence search for each set."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    owner = owner[order]
    values, first, count = np.unique(flat[order], return_index=True, return_counts=True)
    for q in range(len(sets)) if queries is None else np.flatnonzero(queries).tolist():
        need = int(required(int(sizes[q]), percent))
        at = np.searchsorted(values, sets[q])
        n = count[at]
        which = np.repeat(np.arange(len(at)), n)
        posting = owner[np.arange(len(which)) + np.repeat(first[at] - np.cumsum(n) + n, n)]
        other = posting > q if queries is None else ~queries[posting]  # each pair is compared once
        posting, length = posting[other], np.bincount(which[other], minlength=len(at))
        lists = np.flatnonzero(length)
        if len(lists) < need:
            continue
        ends = np.cumsum(length)
        lists = lists[np.argsort(length[lists], kind="stable")]
        n_long = min(int(need / (MERGE_COST * log2(length[lists[-1]] + 1) + 1)), need - 1)
        cut = [posting[ends[i] - length[i] : ends[i]] for i in lists.tolist()]
        short, long_ = cut[: len(cut) - n_long], cut[len(cut) - n_long :]
        who, overlap = heap_merged(short)
        who, overlap = who[overlap >= need - n_long], overlap[overlap >= need - n_long]
        for x in long_ if len(who) else ():
            place = np.minimum(np.searchsorted(x, who), len(x) - 1)
            overlap += x[place] == who
        similar = who[100 * overlap >= percent * (sizes[q] + sizes[who] - overlap)]
        if len(similar):
            yield q, similar


def counted_links(links: Iterator[tuple[int, np.ndarray]], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set of a block, the weight of all it links to, and a set (or itself) to which it leads; following these joins all that links connect."""
    count = np.zeros(len(weights), np.int64)
    label, parent = np.arange(len(weights)), np.arange(len(weights))
    for q, similar in links:
        count[q] += weights[similar].sum()
        count[similar] += weights[q]
        joined = np.unique(np.append(label[similar], label[q]))
        parent[joined[1:]] = joined[0]  # a label is the least set of its class, and no one's child yet
        label[np.isin(label, joined)] = joined[0]
    return count, parent


LINKS = "a long, b long, n long"


def search_blocks(members: DataFrame, percent: int) -> DataFrame:
    """One row for each set with links in its block (family, part_a, part_b): how many documents they lead to, and a set it is connected with.

    Rows of `members` are (family, part_a, part_b, own, id, n, copies, shingles). A block
    of two parts holds the links from the first to the second. Links themselves, which may
    be as many as pairs, stay in the block.
    """
    def links(group: pa.Table) -> pa.Table:
        ids, sizes, copies = (group.column(c).to_numpy() for c in ("id", "n", "copies"))
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        a, b = (group.column(c)[0].as_py() for c in ("part_a", "part_b"))
        count, parent = counted_links(block_links(sets, sizes, percent, group.column("own").to_numpy() == a if a != b else None), copies)
        on = count > 0
        return pa.table({"a": pa.array(ids[on], pa.int64()), "b": pa.array(ids[parent[on]], pa.int64()), "n": pa.array(count[on], pa.int64())})

    return members.groupBy("family", "part_a", "part_b").applyInArrow(links, LINKS)


def families(sets: DataFrame, percent: int) -> DataFrame:
    """(id, family) of all sets that share a prefix shingle with another, directly or by way of others."""
    prefix = materialize(prefixes(sets, percent), "prefixes")
    heads = prefix.groupBy("shingle").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a < last")
    edges = prefix.join(heads, "shingle").select("a", F.col("id").alias("b"))
    return components(edges).select(F.col("node").alias("id"), F.col("component").alias("family"))


def set_links(sets: DataFrame, copies: DataFrame, percent: int, block_sets: int = BLOCK_SETS) -> DataFrame:
    """Links of all similar sets (rows of shared_shingles, written) as search_blocks gives them; `copies` has the documents of each set (id, copies)."""
    family = families(sets, percent)
    size = family.groupBy("family").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("parts"))
    rows = family.join(size, "family").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.join(sets.select("id", "n", "shingles"), "id").join(copies, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = rows.select("family", "id", "n", "copies", "shingles", "own", F.least("own", "other").alias("part_a"), F.greatest("own", "other").alias("part_b"))
    return search_blocks(dealt, percent)


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(id, shingle): the shingles, rarest first, of which any similar set has one among its own."""
    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for i, n, data, counts in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "shingles", "counts"))):
                own, count = np.frombuffer(data, np.uint64), np.frombuffer(counts, np.uint32)
                # Shingles that no other set has are rarer than all of these.
                take = len(own) - required(n, percent) + 1
                chosen = own[np.lexsort((own, count))[:take]]
                ids.append(np.full(len(chosen), i))
                found.append(chosen)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(found).view(np.int64))], ["id", "shingle"])

    return sets.select("id", "n", "shingles", "counts").mapInArrow(rare, "id long, shingle long")


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text) of each row; equal ids with equal keys have equal texts."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def labelled_sets(members: DataFrame, texts: DataFrame, width: int, percent: int, block_sets: int) -> DataFrame:
    """The distinct sets of `members` (signatures, written): head, the smallest id that has it, copies, ids that have it, component, the smallest id that links reach from there, and others, ids of sets it links to."""
    heads = members.where("n_shingles > 0").groupBy("n_shingles", "s0", "s1").agg(F.min("id").alias("head"), F.count_distinct("id").alias("copies"))
    distinct = heads.select(F.col("head").alias("id"), F.col("n_shingles").alias("n"), "s0", "s1")
    near = shared_shingles(text_postings(texts, width), percent).join(distinct, ["id", "n", "s0", "s1"], "left_semi")
    # Rows of one id and set may come from several batches.
    near = materialize(near.select("id", "n", "s0", "s1", "shingles").dropDuplicates(["id"]), "near-sets")
    sets = materialize(shared_shingles(set_postings(near), percent), "similar-sets")
    copies = heads.where("head is not null").select(F.col("head").alias("id"), "copies")
    links = materialize(set_links(sets, copies, percent, block_sets), "set-links")
    found = components(links)
    counted = links.groupBy(F.col("a").alias("head")).agg(F.sum("n").alias("others"))
    return heads.join(found.select(F.col("node").alias("head"), "component"), "head", "left").join(counted, "head", "left")


def similar_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row: the size of its set, the smallest id that links reach, and how many other ids link to it."""
    texts = texts_of(docs, id_col, text_col)
    members = materialize(signatures(texts, width), "signatures")
    labelled = labelled_sets(members, texts.drop("key"), width, percent, block_sets)
    own = members.join(labelled, ["n_shingles", "s0", "s1"], "left")
    n_links = F.coalesce("others", F.lit(0)) + F.coalesce("copies", F.lit(0)) - F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), 1).otherwise(0)
    return own.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "head", "id").alias("component_id"), n_links.alias("n_links"))


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """Of each class of rows whose texts link one row, with all columns: that of the smallest id, of several texts of that id one.

    A row goes only if the set of its own text is in the class of the row that stays, so
    unrelated texts of one id both stay. Texts without words link with nothing and all
    stay. A row without an id stays only where no row of its class has one. Of rows equal
    in id and text one stays. Texts are told apart by hashes of 64 bits.
    """
    texts = texts_of(docs, id_col, text_col)
    members = materialize(signatures(texts, width), "signatures")
    # Here a text's key is its id, as one id may have several texts, and some rows have none.
    by_key = [df.drop("id").withColumnRenamed("key", "id") for df in (members, texts)]
    labelled = labelled_sets(*by_key, width, percent, block_sets)
    own = members.where("n_shingles > 0").join(labelled, ["n_shingles", "s0", "s1"])
    first = own.groupBy(F.coalesce("component", "head").alias("c")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    names = unused(docs.columns, "none", "id", "key", "place")
    none, whole, key, place = names
    marks = dict(zip(names, (F.col(id_col).isNull(), F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.xxhash64(F.col(text_col).cast("string")))))
    marked = docs.withColumns(marks)
    chosen = first.select(F.col("first.none").alias(none), F.coalesce("first.id", F.lit(0)).alias(whole), F.col("first.key").alias(key))
    has_words = F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rank = F.row_number().over(Window.partitionBy(none, whole, key).orderBy(text_col))
    kept = marked.where(has_words).join(chosen, [none, whole, key], "left_semi").withColumn(place, rank).where(F.col(place) == 1)
    return kept.select(docs.columns).union(docs.where(~has_words))


def unused(taken: list[str], *wanted: str) -> list[str]:
    """Column names like those wanted that no column has, in any case."""
    known, found = {c.lower() for c in taken}, []
    for name in wanted:
        while name in known:
            name = f"_{name}"
        known.add(name)
        found.append(name)
    return found
