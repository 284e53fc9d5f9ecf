"""Benchmark decontamination by greedy string tiling.

Items and documents are word sequences (see words.py). A seed is a run of
`min_match` words that both share. Where seeds meet, the longest run of words
that both hold unmarked is marked as a tile, again and again, until no run of
`min_match` words is left; runs of one length are found by running Karp-Rabin
hashes and compared word by word. The share of an item's words under tiles is
its coverage, whatever the order of the tiles in the document.

1. Items become words and seeds, one row each. Their hashes fill a filter of
   `FILTER_BITS` bits: the only thing that goes to all tasks, and of fixed size.
2. Documents are read once. Of each, the runs that pass the filter leave, with the
   words under them; words outside every seed belong to no tile.
3. A join by seed counts the seeds of each document and item; only pairs that have
   enough for the threshold are tiled, each in a row with both word sequences.

Neither items nor documents pass the driver, and no task holds more than a batch of
them. A filter that many items have filled lets more runs into the join, which then
finds the same pairs.

Null or empty texts and items match nothing. An item shorter than `min_match`
words is a seed as a whole. Equal items and equal rows are reported each; null
ids stay null. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from airmart.llm.words import blocks, mixed, runs
from airmart.session import materialize

MIN_MATCH = 4
THRESHOLD = 0.6
FILTER_BITS = 24
Tile = tuple[int, int, int]


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> list[Tile]:
    """(place in the item, place in the document, length) of each tile, longest first."""
    min_match = min(min_match, len(item))
    if not min_match:
        return []
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    found: list[Tile] = []
    length = min(len(item), len(doc))
    while length >= min_match:
        length = longest(item, doc, free_item, free_doc, min_match, length)
        if not length:
            break
        for i, j in matches(item, doc, free_item, free_doc, length):
            if free_item[i : i + length].all() and free_doc[j : j + length].all():
                free_item[i : i + length] = free_doc[j : j + length] = False
                found.append((i, j, length))
        length -= 1
    return found


def longest(item, doc, free_item, free_doc, low: int, high: int) -> int:
    """Length of the longest run that both hold unmarked, within the bounds; 0 if there is none."""
    if not matches(item, doc, free_item, free_doc, low, True):
        return 0
    while low < high:  # a run holds a run of every smaller length
        middle = (low + high + 1) // 2
        if matches(item, doc, free_item, free_doc, middle, True):
            low = middle
        else:
            high = middle - 1
    return low


def matches(item, doc, free_item, free_doc, length: int, any_one: bool = False) -> list[tuple[int, int]]:
    """Places of equal unmarked runs of one length, by running hashes and then word by word."""
    at_item, at_doc = unmarked(free_item, length), unmarked(free_doc, length)
    if not len(at_item) or not len(at_doc):
        return []
    hash_item, hash_doc = runs(item, length)[at_item], runs(doc, length)[at_doc]
    order = np.argsort(hash_doc, kind="stable")
    low = np.searchsorted(hash_doc[order], hash_item, "left")
    high = np.searchsorted(hash_doc[order], hash_item, "right")
    found = []
    for i, a, b in zip(at_item.tolist(), low.tolist(), high.tolist()):
        for j in at_doc[order[a:b]].tolist():
            if (item[i : i + length] == doc[j : j + length]).all():
                found.append((i, j))
                if any_one:
                    return found
    return found


def unmarked(free: np.ndarray, length: int) -> np.ndarray:
    """Places at which `length` words in a row are unmarked."""
    total = np.append(0, np.cumsum(free))
    return np.flatnonzero(total[length:] - total[:-length] == length) if len(free) >= length else np.zeros(0, np.int64)


# -- seeds -----------------------------------------------------------------


def seeds_of(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of a width, which differ by width."""
    return mixed(runs(words, width) + np.uint64(width))


def items_as_words(items: DataFrame, id_col: str, text_col: str, min_match: int) -> DataFrame:
    """(item, item_id, n, width, words, seeds, counts: their places in the item) of each item with words; written, so that item numbers stay."""
    own = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    kind = own.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, places = [], []
            for at, words in blocks(batch.column("text")):
                for k in range(len(words.off) - 1):
                    own = words.text(k)
                    if len(own):
                        width = min(min_match, len(own))
                        seeds, counts = np.unique(seeds_of(own, width), return_counts=True)
                        rows.append(((part << 40) + number, len(own), width, own.tobytes(), seeds.view(np.int64).tolist(), counts.tolist()))
                        places.append(at + k)
                        number += 1
            if rows:
                item, n, width, data, seeds, counts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item), batch.column("item_id").take(pa.array(places)), pa.array(n, pa.int64()), pa.array(width, pa.int32()), pa.array(data, pa.binary()), pa.array(seeds, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))],
                    ["item", "item_id", "n", "width", "words", "seeds", "counts"],
                )

    return materialize(own.mapInArrow(cut, f"item long, item_id {kind}, n long, width int, words binary, seeds array<long>, counts array<long>"), "items")


def seed_filter(seeds: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Which values the lowest `bits` bits of seeds take; words of 64 bits are put together by Spark, and no more than all of them reach the driver."""
    slot = F.col("seed").bitwiseAND(F.lit((1 << bits) - 1))
    words = seeds.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((seed & {(1 << bits) - 1}) & 63 as int))")).alias("b"))
    found = words.collect()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[[r.w for r in found]] = np.array([r.b for r in found], np.int64).view(np.uint64)
    return out


def passes(known: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    slot = seeds & np.uint64(64 * len(known) - 1)
    return (known[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


HITS = "doc long, key long, places binary, words binary, seeds array<long>"


def document_hits(docs: DataFrame, widths: list[int], known: np.ndarray) -> DataFrame:
    """(doc, doc_id, key, places, words, seeds): runs of each row of (doc_id, key, text) that pass the filter, and the words under them in order with their places."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, words in blocks(batch.column("text")):
                rows, places = [], []
                for k in range(len(words.off) - 1):
                    own, inside, seeds = words.text(k), [], []
                    for width in widths:
                        found = seeds_of(own, width)
                        hit = np.flatnonzero(passes(known, found)) if len(found) else []
                        if len(hit):
                            inside.append(np.add.outer(hit, np.arange(width)).ravel())
                            seeds.append(found[hit])
                    if inside:
                        where = np.unique(np.concatenate(inside))
                        rows.append(((part << 40) + number, where.astype(np.int64).tobytes(), own[where].tobytes(), np.unique(np.concatenate(seeds)).view(np.int64).tolist()))
                        places.append(at + k)
                    number += 1
                if rows:
                    doc, where, data, seeds = zip(*rows)
                    chosen = batch.take(pa.array(places))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc), chosen.column("key"), pa.array(where, pa.binary()), pa.array(data, pa.binary()), pa.array(seeds, pa.list_(pa.int64())), chosen.column("doc_id")],
                        ["doc", "key", "places", "words", "seeds", "doc_id"],
                    )

    return docs.mapInArrow(search, f"{HITS}, doc_id {kind}")


def tiled(item: np.ndarray, words: np.ndarray, places: np.ndarray, min_match: int) -> list[Tile]:
    """Tiles of an item in the words of a document that lie under seeds; a gap between their places is no word."""
    gaps = np.flatnonzero(np.diff(places) > 1) + 1
    where, doc = np.insert(places, gaps, -1), np.insert(words, gaps, 0)  # no word has this hash but by chance, and then words are compared
    return [(i, int(where[j]), n) for i, j, n in tiles(item, doc, min_match)]


def pairs_tiled(docs: DataFrame, items: DataFrame, doc_id: str, text_col: str, item_id: str, item_text: str, min_match: int, threshold: float, filter_bits: int) -> DataFrame:
    """As `tilings`, with the key (hash) of each document's text."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    known = items_as_words(items, item_id, item_text, min_match)
    # Each place of a seed covers `width` words at most.
    seeds = known.select(F.explode(F.arrays_zip("seeds", "counts")).alias("s"), "item", "n", "width").select(
        F.col("s.seeds").alias("seed"), "item", (F.col("s.counts") * F.col("width")).alias("reach"), (F.col("n") * F.lit(threshold)).alias("need"))
    widths = sorted(r[0] for r in known.select("width").distinct().collect())  # min_match of them at most
    tile = StructType([StructField(n, LongType()) for n in ("item_word", "doc_word", "n_words")])
    schema = StructType([
        StructField("doc_id", texts.schema["doc_id"].dataType), StructField("key", LongType()), StructField("item_id", known.schema["item_id"].dataType), StructField("n_covered", LongType()),
        StructField("n_words", LongType()), StructField("coverage", DoubleType()), StructField("tiles", ArrayType(tile)),
    ])
    hits = materialize(document_hits(texts, widths, seed_filter(seeds, filter_bits)), "seed-hits")
    met = hits.select("doc", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("doc", "item").agg(F.sum("reach").alias("reach"), F.max("need").alias("need")).where("reach >= need")
    both = met.select("doc", "item").join(hits.select("doc", "doc_id", "key", "places", "words"), "doc").join(known.select("item", "item_id", F.col("words").alias("item_words")), "item")

    def tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, found = [], []
            for k, (words, places, item) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("words", "places", "item_words")))):
                item = np.frombuffer(item, np.uint64)
                own = tiled(item, np.frombuffer(words, np.uint64), np.frombuffer(places, np.int64), min_match)
                covered = sum(t[2] for t in own)
                if own and covered >= threshold * len(item):
                    place.append(k)
                    found.append((covered, len(item), covered / len(item), [dict(zip(("item_word", "doc_word", "n_words"), t)) for t in own]))
            if found:
                chosen = batch.take(pa.array(place))
                n_covered, n_words, share, lists = map(pa.array, zip(*found))
                yield pa.RecordBatch.from_arrays([chosen.column("doc_id"), chosen.column("key"), chosen.column("item_id"), n_covered, n_words, share, lists], schema.names)

    return both.mapInArrow(tile_pairs, schema)


def tilings(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", min_match: int = MIN_MATCH, threshold: float = THRESHOLD, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """A row for each document and item covered up to the threshold or beyond, with the tiles."""
    return pairs_tiled(docs, items, doc_id, text_col, item_id, item_text, min_match, threshold, filter_bits).drop("key")


def without_covered(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", min_match: int = MIN_MATCH, threshold: float = THRESHOLD, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The documents that cover no item up to the threshold; rows go by their own text, whatever else has their id."""
    found = pairs_tiled(docs, items, doc_id, text_col, item_id, item_text, min_match, threshold, filter_bits)
    bad = materialize(found.select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key")).distinct(), "covered")
    same = docs[doc_id].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs[text_col].cast("string")) == bad["bad_key"])
    return docs.join(bad, same, "left_anti")
