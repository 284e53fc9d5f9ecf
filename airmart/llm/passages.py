"""Passages that repeat across or within documents, by compact windows.

A text is its sequence of five-word shingles; a window is as many of them as a
passage of `min_words` has. Two windows are linked if the sets of their shingles
have `percent` per cent of their union in common; within a document they may not
overlap. All documents with a linked window are found, in groups of any size:

1. Shingles are counted by 40 bits of their hashes, in slices. A filter of bounded
   size holds those that repeat and how often, roughly; it may err only by more.
   A window in which too few shingles repeat has no link. What the others cover is
   kept as spans of hashes; the texts are not read again.
2. A compact window (l, c, r) says that every stretch that begins in l..c and ends in
   c..r has its smallest hash at c. The windows of one compact window that have
   the same sets of repeated shingles and as many others, in the same order, are
   folded into the first such: they have the same links. Windows are folded only if
   that makes them linked themselves.
3. The shingles of a window are ordered by how often they repeat, seldom ones first.
   Two linked windows share a shingle among the first few of each (as many as may be
   missing from the other, and one more; fewer if both have no shingle twice). So
   linked spans share such a seed, and those of folded windows are paired with the
   span of the first. `repeated_passages` pairs spans that share a seed all with all.
   `passage_classes` compares them with one span of each seed, that with the most
   common surroundings; then those with windows that nothing found so far covers
   with up to 16 of each kind; then windows still uncovered with all spans that share
   a seed, and spans of documents that are not yet of one class. What it leaves
   out is pairs of covered windows of documents of one class. A window counts as
   covered if all its shingles but as many as may be missing from a linked window
   lie in passages found.
4. The shingles of paired spans are compared: what is reported has `percent` per cent
   of the union of its distinct shingles in common with its partner, over a passage's
   length or more. Of several places of a shingle in the partner's span the one
   nearest the spans' shift counts; where that fails, a window is compared with all
   windows of the partner. Of several places in a partner one is reported.

Each row is a passage of a document with the passage it repeats; the document that has
the first occurrence appears as partner. `repeated_passages` gives all pairs of different
texts; copies have a row with the first one. `passage_classes` gives some partner of
each passage and the class of its document (the smallest one reachable by links), and
spans that are partners only have rows of their own. Null or short texts
have no windows. Rows with a null id take no part. Repeated rows repeat each other
if their ids differ; rows that share an id count as one document whose text is the
smallest. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from airmart.llm.components import components
from airmart.llm.words import Words, blocks, mixed, runs
from airmart.session import materialize

WIDTH, MIN_WORDS, PERCENT = 5, 50, 80
HASHES = 4  # places of a shingle in the filter
FILTER_BITS, SLICES = 1 << 20, 256  # a slice, slices
TOP = 12
HUBS = 16  # spans of a seed that are tried before all others
BLOCK, PLACES, PAIRS = 1 << 20, 1 << 18, 1 << 8  # bytes of text, places and pairs of spans looked at together
# The lower half of a key is the place, so that ties go by place; Arrow holds no text with more places.
_PLACE = np.uint64((1 << 32) - 1)


def stored(df: DataFrame, label: str) -> DataFrame:
    """As `materialize`. Shuffle files of what was written go when the driver collects garbage, so it is asked to."""
    spark = df.sparkSession
    written = materialize(df, label)
    del df
    spark.sparkContext._jvm.System.gc()
    return written


def block_shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the shingle that begins at each word, and whether there is one."""
    hashes = np.zeros(len(words), np.uint64)
    if len(words) >= width:
        hashes[: len(words) - width + 1] = runs(words.hash, width)
    left = np.repeat(words.first[1:], words.counts()) - np.arange(len(words))
    return hashes, left >= width


def compact_windows(hashes: np.ndarray, valid: np.ndarray, seed: int, length: int, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c and r of all compact windows of at least `length` shingles; texts are parted by places that are not valid, those of `last` come after all others."""
    key = (mixed(hashes + np.uint64(seed)) | np.uint64(1 << 63)) & ~_PLACE | np.arange(len(hashes), dtype=np.uint64)
    if last is not None:
        key = np.where(last, key | np.uint64(1 << 62), key & ~np.uint64(1 << 62))
    key[~valid] = 0
    levels = [key]
    for j in range(1, TOP + 1):
        last, half = levels[-1], 1 << (j - 1)
        levels.append(np.minimum(last[:-half], last[half:]) if len(last) > half else np.zeros(0, np.uint64))
    p = min(length.bit_length() - 1, TOP)
    if len(levels[p]) < length - (1 << p) + 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    shift = length - (1 << p)
    low = np.minimum(levels[p][: len(levels[p]) - shift], levels[p][shift:])
    c = np.unique((low[low > 0] & _PLACE).astype(np.int64))
    own, left, right = key[c], c.copy(), c.copy()

    def move(at: np.ndarray, j: int, sign: int) -> bool:
        start = at - (1 << j) if sign < 0 else at + 1
        inside = (start >= 0) & (start < len(levels[j]))
        higher = inside.copy()
        higher[inside] = levels[j][start[inside]] > own[inside]
        at += sign * (higher * (1 << j))
        return bool(higher.any())

    for at, sign in ((left, -1), (right, 1)):
        while move(at, TOP, sign):
            pass
        for j in range(TOP - 1, -1, -1):
            move(at, j, sign)
    return left, c, right


def least_shared(length: int, percent: int) -> int:
    """Shingles that two stretches of `length` distinct ones have to share."""
    return -(-2 * length * percent // (100 + percent))


SLICE = "slice int, counts binary, low binary"
FILTER = "slice int, bits binary, levels binary"


class Filter:
    """Which shingles repeat, and how often, roughly; none that repeats is missing."""

    def __init__(self, slices: dict[int, tuple[bytes, bytes]]):
        parts = [slices.get(k, (b"\0", b"\0")) for k in range(SLICES)]
        self.bits, self.levels = (np.frombuffer(b"".join(p[k] for p in parts), np.uint8) for k in (0, 1))
        size, rough = (np.array([len(p[k]) for p in parts]) for k in (0, 1))
        self.base, self.rough_base = ((np.cumsum(x) - x).astype(np.uint64) for x in (size, rough))
        self.mask, self.rough_mask = (size * 8 - 1).astype(np.uint64), (rough * 2 - 1).astype(np.uint64)

    def look(self, hashes: np.ndarray) -> np.ndarray:
        """0 for shingles that occur once, else a level that grows with their number."""
        part, spread = (hashes >> np.uint64(56)).astype(np.intp), mixed(hashes >> np.uint64(24))
        at = np.arange(len(hashes))
        for k in range(HASHES):
            place = filter_place(spread[at], k) & self.mask[part[at]]
            found = self.bits[self.base[part[at]] + (place >> np.uint64(3))] >> (place & np.uint64(7)).astype(np.uint8) & 1
            at = at[found > 0]
        place = rough_place(spread[at]) & self.rough_mask[part[at]]
        out = np.zeros(len(hashes), np.uint8)
        level = self.levels[self.rough_base[part[at]] + (place >> np.uint64(1))] >> (place & np.uint64(1)).astype(np.uint8) * np.uint8(4) & 15
        out[at] = np.maximum(level, 1)
        return out


def filter_place(spread: np.ndarray, k: int) -> np.ndarray:
    return spread >> np.uint64(11 * k)


def rough_place(spread: np.ndarray) -> np.ndarray:
    return spread >> np.uint64(40)


def repeated_shingles(texts: DataFrame, width: int) -> Filter:
    """The filter of all shingles of (id, text). Only its slices, of bounded size, come to the driver."""
    def slices(short: np.ndarray) -> pa.RecordBatch:
        short = np.sort(short)
        counts = np.bincount((short >> np.uint64(24)).astype(np.intp), minlength=SLICES * 256).reshape(SLICES, 256).astype(np.uint32)
        low = short.astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :3]
        ends = np.append(0, np.cumsum(counts.sum(axis=1, dtype=np.int64)))
        some = [k for k in range(SLICES) if ends[k] < ends[k + 1]]
        columns = [pa.array(some, pa.int32()), pa.array([counts[k].tobytes() for k in some], pa.binary()), pa.array([low[ends[k] : ends[k + 1]].tobytes() for k in some], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SLICE.split(", ")])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in batches:
            for _, words in blocks(batch.column("text"), BLOCK):
                own, valid = block_shingles(words, width)
                found.append(own[valid] >> np.uint64(24))
                if sum(map(len, found)) >= PLACES << 4:
                    yield slices(np.concatenate(found))
                    found = []
        if found:
            yield slices(np.concatenate(found))

    def reduced(table: pa.Table) -> pa.Table:
        found = []
        for counts, low in zip(table.column("counts"), table.column("low")):
            wide = np.zeros((len(low.as_buffer()) // 3, 4), np.uint8)
            wide[:, :3] = np.frombuffer(low.as_buffer(), np.uint8).reshape(-1, 3)
            wide[:, 3] = np.repeat(np.arange(256), np.frombuffer(counts.as_buffer(), np.uint32))
            found.append(wide.view(np.uint32)[:, 0])
        values, n = np.unique(np.concatenate(found), return_counts=True)
        values, n = values[n > 1], n[n > 1]
        part = table.column("slice")[0].as_py()
        size = min(FILTER_BITS, 1 << max(10, (16 * len(values)).bit_length()))
        spread = mixed(np.uint64(part << 32) | values.astype(np.uint64))
        bits, levels = np.zeros(size, bool), np.zeros(size // 4, np.uint8)
        for k in range(HASHES):
            bits[filter_place(spread, k) & np.uint64(size - 1)] = True
        np.maximum.at(levels, rough_place(spread) & np.uint64(size // 4 - 1), np.ceil(np.log2(n)).clip(1, 15).astype(np.uint8))
        levels = levels[::2] | levels[1::2] << 4
        return pa.table([pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()), pa.array([levels.tobytes()], pa.binary())], ["slice", "bits", "levels"])

    rows = texts.mapInArrow(packed, SLICE).groupBy("slice").applyInArrow(reduced, FILTER).collect()
    return Filter({r.slice: (bytes(r.bits), bytes(r.levels)) for r in rows})


SPANS = "id long, start int, low binary, high binary, levels binary"


def spans(texts: DataFrame, width: int, length: int, percent: int) -> DataFrame:
    """What windows with enough repeated shingles cover: hashes (lower and upper halves) and levels, and a hash for each span."""
    repeated = texts.sparkSession.sparkContext.broadcast(repeated_shingles(texts, width))
    missing = length * (100 - percent) // 100  # shingles that occur once are distinct

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for at, words in blocks(batch.column("text"), BLOCK):
                own, valid = block_shingles(words, width)
                if len(own) < length:
                    continue
                level = repeated.value.look(own)
                once, there = (np.append(0, np.cumsum(x)) for x in ((level == 0) & valid, valid))
                begin = np.flatnonzero((there[length:] - there[:-length] == length) & (once[length:] - once[:-length] <= missing))
                if not len(begin):
                    continue
                cuts = np.flatnonzero(np.append(True, np.diff(begin) > length))
                first, last = begin[cuts], np.append(begin[cuts[1:] - 1], begin[-1]) + length
                doc = np.searchsorted(words.first, first, side="right") - 1
                low, high = own.astype(np.uint32), (own >> np.uint64(32)).astype(np.uint32)
                columns = [pa.array(ids[at + doc].astype(np.int64)), pa.array((first - words.first[doc]).astype(np.int32))]
                columns += [pa.array([x[i:j].tobytes() for i, j in zip(first, last)], pa.binary()) for x in (low, high, level)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SPANS.split(", ")])

    return stored(texts.mapInArrow(cut, SPANS).withColumn("node", F.xxhash64("id", "start")), "spans")


FOLDS = "key long, node long, id long, start int, seeds array<long>"
SEEDS = "node long, seed long"
BOTH_FULL, FULL, SHORT = 0, 1, 2  # kinds of seeds, in the lowest bits
SEED_BITS = 12  # lowest bits of a seed that do not count as its hash
_COMMON = (1 << SEED_BITS - 2) - 1


def prefix(distinct: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Of so many first shingles of a window one is in each window linked with it."""
    return distinct + -distinct * percent // 100 + 1


def seeds_of(hashes: np.ndarray, order: np.ndarray, level: np.ndarray, at: np.ndarray, distinct: np.ndarray, length: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The window (as a place in `at`) and the hash of each first shingle that repeats; the lowest bits say how common the shingles around it are and between which windows it counts."""
    few, more = length - least_shared(length, percent) + 1, prefix(length, percent)
    window, seed = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    total, places = np.append(0, np.cumsum(level, dtype=np.int64)), np.arange(len(level))
    common = (total[np.minimum(places + length, len(level))] - total[np.maximum(places - length + 1, 0)]) * _COMMON // (30 * length)
    own = hashes >> np.uint64(SEED_BITS) << np.uint64(SEED_BITS) | common.astype(np.uint64) << np.uint64(2)

    def add(rows: np.ndarray, places: np.ndarray, kind: np.ndarray) -> None:
        on = level[places] > 0
        window.append(rows[on])
        seed.append(own[places[on]] | kind[on].astype(np.uint64))

    for begin in range(0, len(at), 1 << 14):
        rows = np.arange(begin, min(begin + (1 << 14), len(at)))
        for full in (True, False):
            some = rows[(distinct[rows] == length) == full]
            if not len(some):
                continue
            keys = order[at[some][:, None] + np.arange(length)]
            if full:
                place = np.argpartition(keys, sorted({few - 1, more - 1}), axis=1)[:, :more]
                add(np.repeat(some, more), (at[some][:, None] + place).ravel(), np.tile(np.where(np.arange(more) < few, BOTH_FULL, FULL), len(some)))
            else:
                place = np.argsort(keys, axis=1, kind="stable")
                keys = np.take_along_axis(keys, place, axis=1)
                new = np.column_stack([np.ones(len(some), bool), keys[:, 1:] != keys[:, :-1]])
                i, j = np.nonzero(new & (np.cumsum(new, axis=1) <= prefix(distinct[some], percent)[:, None]))
                add(some[i], at[some[i]] + place[i, j], np.full(len(i), SHORT))
    return np.concatenate(window), np.concatenate(seed)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive spans of up to `PLACES` places together (a longer one is alone)."""
    for batch in batches:
        ends = np.cumsum([len(x) for x in batch.column("levels").to_pylist()])
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PLACES, side="right")))
            yield batch.slice(at, to - at)
            at = to


class Stretches:
    """Spans one after another: their shingles and, by first place and span, their windows in which enough shingles repeat."""

    def __init__(self, batch: pa.RecordBatch, length: int, percent: int):
        self.length, self.percent = length, percent
        self.nodes = batch.column("node").to_numpy()
        low, high, levels = (batch.column(x).to_pylist() for x in ("low", "high", "levels"))
        sizes = np.array([len(x) for x in levels])
        ends = np.cumsum(sizes + 1)  # a place that is not valid ends each span
        self.first = ends - sizes - 1
        self.hashes = np.frombuffer(b"\0\0\0\0".join(high) + b"\0\0\0\0", np.uint32).astype(np.uint64) << np.uint64(32) | np.frombuffer(b"\0\0\0\0".join(low) + b"\0\0\0\0", np.uint32)
        self.level = np.frombuffer(b"\0".join(levels) + b"\0", np.uint8)
        self.valid = np.ones(len(self.hashes), bool)
        self.valid[ends - 1] = False
        self.spread = mixed(self.hashes)
        on = self.level > 0
        weights = np.column_stack([np.ones(len(on), np.uint64), on.astype(np.uint64), np.where(on, self.spread, np.uint64(0))])
        distinct, hit, self.content = sums_of_distinct(self.hashes, weights, length).T
        self.distinct, self.hit = distinct.astype(np.int64), hit.astype(np.int64)
        there = np.append(0, np.cumsum(self.valid))
        self.at = np.flatnonzero((there[length:] - there[:-length] == length) & (100 * self.hit >= percent * self.distinct))
        self.span = np.searchsorted(self.first, self.at, side="right") - 1

    def seeds(self, at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owners of windows with the distinct seeds of their windows, in order."""
        order = (self.level.astype(np.uint64) << np.uint64(60)) | self.spread >> np.uint64(4)
        window, seed = seeds_of(self.hashes, order, self.level, at, self.distinct[at], self.length, self.percent)
        by = np.lexsort((seed, owner[window]))
        owner, seed = owner[window][by], seed[by]
        new = np.append(True, (np.diff(owner) != 0) | (seed[1:] != seed[:-1]))[: len(seed)]
        return owner[new], seed[new]


def folds(found: DataFrame, length: int, percent: int) -> DataFrame:
    """Runs of windows of spans, with a key for what they hold and the first shingles of their windows."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            own = Stretches(batch, length, percent)
            at, span = own.at, own.span
            if not len(at):
                continue
            hit, distinct = own.hit[at], own.distinct[at]
            alike = 100 * hit >= percent * (2 * distinct - hit)
            content = mixed(own.content[at] + mixed(distinct.astype(np.uint64)))
            alone = mixed(own.nodes[span].astype(np.uint64) ^ mixed((at - own.first[span]).astype(np.uint64)))
            content = np.where(alike, content, mixed(content + alone))
            left, c, right = compact_windows(own.hashes, own.valid, 1, length, own.level == 0)
            compact = np.searchsorted(np.maximum(left, c - length + 1), at, side="right")
            cuts = np.append(True, (np.diff(at) > 1) | (np.diff(compact) != 0) | (np.diff(span) != 0) | (alike[1:] != alike[:-1]))
            keep = cuts | np.append(True, content[1:] != content[:-1])
            at, span, content, cuts = at[keep], span[keep], content[keep], cuts[keep]
            run, begin = np.cumsum(cuts) - 1, np.flatnonzero(cuts)
            rank = np.arange(len(at)) - begin[run]
            key = mixed(np.add.reduceat(mixed(content + mixed(rank.astype(np.uint64))), begin))
            owner, seed = own.seeds(at, run)
            offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(begin)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(seed.view(np.int64)))
            columns = [pa.array(key.view(np.int64)), *(batch.column(x).take(pa.array(span[begin])) for x in ("node", "id", "start")), lists]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in FOLDS.split(", ")])

    return found.select("node", "id", "start", "low", "high", "levels").mapInArrow(cut, FOLDS)


def folded(found: DataFrame, length: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of spans of folded windows with those of the first such, and the seeds of first windows."""
    runs_of = stored(folds(found, length, percent), "folds")
    order = Window.partitionBy("key").orderBy("id", "start", "node")
    both = runs_of.withColumn("other", F.first("node").over(order))
    copies = stored(each_once(both.select("node", "other")), "copies")
    seeds = both.where("node = other").select("node", F.explode("seeds").alias("seed"))
    return copies, stored(unpacked(seeds), "seeds")


def unpacked(seeds: DataFrame) -> DataFrame:
    bits = F.col("seed").bitwiseAND((1 << SEED_BITS) - 1)
    seeds = seeds.select("node", F.shiftright("seed", SEED_BITS).alias("seed"), bits.bitwiseAND(3).cast("byte").alias("kind"), F.shiftright(bits, 2).cast("short").alias("common"))
    return seeds.groupBy("node", "seed", "kind").agg(F.max("common").alias("common"))


def each_once(pairs: DataFrame) -> DataFrame:
    return pairs.where("node <> other").select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")).distinct()


def all_with_all(some: DataFrame, seeds: DataFrame, *differ: str) -> DataFrame:
    """Pairs of spans with a seed in common between windows for which it counts, and nothing in common in the columns named."""
    partner = seeds.select(*(F.col(c).alias(f"other_{c}") for c in ("seed", "node", "kind", *differ)))
    counts = (F.col("kind") == SHORT) | (F.col("other_kind") == SHORT) | (F.col("kind") == BOTH_FULL) & (F.col("other_kind") == BOTH_FULL)
    for c in ("node", *differ):
        counts &= F.col(c) != F.col(f"other_{c}")
    return some.join(partner, (F.col("seed") == F.col("other_seed")) & counts).select("node", F.col("other_node").alias("other"))


def with_hubs(seeds: DataFrame) -> DataFrame:
    """Pairs of spans with one of those that have a seed in common: the one with the most common shingles around it, as links with others are likeliest there."""
    order = Window.partitionBy("seed").orderBy(F.desc("kind"), F.desc("common"), "node")
    of_kind = [F.first(F.when(F.col("kind") == kind, F.col("node")), ignorenulls=True).over(order) for kind in (BOTH_FULL, SHORT)]
    return seeds.select("node", F.array(*of_kind).alias("hubs")).select("node", F.explode("hubs").alias("other")).where("other is not null")


def some_of_each(seeds: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of each wanted seed `HUBS` spans of each kind, chosen alike for all seeds."""
    order = Window.partitionBy("seed", "kind").orderBy(F.xxhash64("node"), "node")
    some = seeds.join(wanted.select("seed").distinct(), "seed", "left_semi").withColumn("rank", F.row_number().over(order))
    return some.where(F.col("rank") <= HUBS).drop("rank")


def across(seeds: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of spans of different classes with a seed in common; of each pair one is not of the seed's most frequent class."""
    own = stored(seeds.join(classes, "node"), "classed")
    several = own.groupBy("seed").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("seed")
    some = stored(own.join(several, "seed"), "several")
    most = some.groupBy("seed", "class").count().groupBy("seed").agg(F.max_by("class", "count").alias("most"))
    mixed_groups = some.join(most, "seed")
    return all_with_all(mixed_groups.where(F.col("class") != F.col("most")).drop("most"), mixed_groups.drop("most"), "class")


def open_seeds(found: DataFrame, reported: DataFrame, width: int, length: int, percent: int) -> DataFrame:
    """Seeds of the windows that reported passages do not cover, but for as many shingles as may be missing from a linked window."""
    missing = length - least_shared(length, percent)
    sides = [reported.select(F.col(n).alias("node"), F.col(at).alias("at"), (F.col(at) + F.col(size) - width).alias("last")) for n, at, size in (("node", "start_word", "n_words"), ("other", "source_word", "source_words"))]
    longest = sides[0].union(sides[1]).groupBy("node", "at").agg(F.max("last").alias("last"))
    covers = longest.groupBy("node").agg(F.collect_list(F.shiftleft(F.col("at").cast("long"), 32) + F.col("last")).alias("covers"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            own = Stretches(batch, length, percent)
            change = np.zeros(len(own.valid) + 1, np.int64)
            for first, start, covered in zip(own.first.tolist(), batch.column("start").to_pylist(), batch.column("covers").to_pylist()):
                if covered:
                    at = np.array(covered, np.int64)
                    np.add.at(change, first + (at >> 32) - start, 1)
                    np.subtract.at(change, first + (at & 0xFFFFFFFF) - start + 1, 1)
            gaps = np.append(0, np.cumsum(np.cumsum(change[:-1]) == 0))
            bare = gaps[own.at + length] - gaps[own.at] > missing
            if not bare.any():
                continue
            owner, seed = own.seeds(own.at[bare], own.span[bare])
            columns = [pa.array(own.nodes[owner]), pa.array(seed.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SEEDS.split(", ")])

    both = found.select("node", "start", "low", "high", "levels").join(covers, "node", "left")
    return stored(unpacked(both.mapInArrow(cut, SEEDS)), "open-seeds")


def nearest(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """For each shingle of a the place in b, of those with the same shingle, nearest to its own place moved by `shift`; -1 if there is none."""
    values, code = np.unique(b, return_inverse=True)
    rank = np.minimum(np.searchsorted(values, a), len(values) - 1)
    hit = values[rank] == a
    size = len(b) + 1
    both = np.sort(code.astype(np.int64) * size + np.arange(len(b)))
    goal = np.clip(np.arange(len(a)) + shift, 0, len(b))
    after = np.searchsorted(both, rank * size + goal)
    out, best = np.full(len(a), -1), np.full(len(a), size)
    for k in (after - 1, after):
        own = both[np.clip(k, 0, len(both) - 1)]
        far = np.abs(own % size - goal)
        better = hit & (own // size == rank) & (far < best)
        out[better], best[better] = (own % size)[better], far[better]
    return out


def sums_of_distinct(values: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """The sum of the weights of the distinct values in each window of `length`; equal values have equal weights. One column of weights for each sum."""
    n = len(values) - length + 1
    order = np.argsort(values, kind="stable")
    last = np.full(len(values), -1)
    same = values[order][1:] == values[order][:-1]
    last[order[1:][same]] = order[:-1][same]
    at = np.arange(len(values))
    change = np.zeros((n + 1, weights.shape[1]), weights.dtype)
    begin, end = np.minimum(np.maximum(last + 1, at - length + 1).clip(0), n), np.minimum(at + 1, n)
    on = begin < end
    for k in range(weights.shape[1]):
        np.add.at(change[:, k], begin[on], weights[on, k])
        np.subtract.at(change[:, k], end[on], weights[on, k])
    return np.cumsum(change, axis=0, dtype=weights.dtype)[:n]


def distinct_in_windows(values: np.ndarray, counted: np.ndarray, length: int) -> np.ndarray:
    """Distinct counted values in each window of `length`."""
    return sums_of_distinct(values, counted.astype(np.int64)[:, None], length)[:, 0]


class Places:
    """Of each shingle of a its place in b, and how alike stretches of both are."""

    def __init__(self, a: np.ndarray, b: np.ndarray, length: int, percent: int, shift: int | None):
        self.a, self.b, self.length, self.percent = a, b, length, percent
        order, own = np.argsort(b, kind="stable"), np.sort(a)
        there = b[order]
        self.plain = not ((there[1:] == there[:-1]).any() or (own[1:] == own[:-1]).any())  # no shingle twice
        rank = np.minimum(np.searchsorted(there, a), len(b) - 1)
        self.hit = there[rank] == a
        self.where = np.where(self.hit, order[rank], -1)
        self.whole_b: np.ndarray | int | None = length if self.plain else None
        if not self.plain and self.hit.any():
            at = np.flatnonzero(self.hit)
            self.where = nearest(a, b, middle(self.where[at] - at) if shift is None else shift)

    def starts(self) -> np.ndarray:
        """Windows of a of which enough is anywhere in b for one of its windows."""
        if self.plain:
            total = np.append(0, np.cumsum(self.hit))
            return np.flatnonzero(total[self.length :] - total[: -self.length] >= least_shared(self.length, self.percent))
        shared, whole = sums_of_distinct(self.a, np.column_stack([self.hit, np.ones(len(self.a))]).astype(np.int64), self.length).T
        some = 100 * shared >= self.percent * whole
        if some.any():
            self.whole_b = distinct_in_windows(self.b, np.ones(len(self.b), bool), self.length)
            some &= 100 * shared >= self.percent * (whole + np.maximum(self.whole_b.min(), shared) - shared)
        return np.flatnonzero(some)

    def share(self, first: int, last: int, low: int, high: int) -> float:
        if self.plain:
            own = self.where[first : last + 1]
            shared, union = int(((own >= low) & (own <= high)).sum()), last - first + high - low + 2
        else:
            x, y = np.unique(self.a[first : last + 1]), np.unique(self.b[low : high + 1])
            shared, union = len(np.intersect1d(x, y, True)), len(x) + len(y)
        return shared / (union - shared) if 100 * shared >= self.percent * (union - shared) else 0.0

    def partner(self, first: int, last: int) -> tuple[int, int, float] | None:
        """A stretch of b: that of the nearest places, of those close to their middle shift, or that at this shift."""
        at = first + np.flatnonzero(self.hit[first : last + 1])
        own = self.where[at]
        mid = middle(own - at)
        close = own[np.abs(own - at - mid) <= self.length // 5]
        for low, high in ((own.min(), own.max()), (close.min(), close.max()) if len(close) else (0, -1), (max(first + mid, 0), min(last + mid, len(self.b) - 1))):
            if low <= high and (share := self.share(first, last, int(low), int(high))):
                return int(low), int(high), share
        return None

    def anywhere(self, first: int, last: int) -> tuple[int, int, float] | None:
        """The window of b most like a window of a, over all occurrences of its shingles."""
        if self.plain:
            own = self.where[first : last + 1]
            total = np.append(0, np.cumsum(np.bincount(own[own >= 0], minlength=len(self.b))))
            shared, size = total[self.length :] - total[: -self.length], self.length
        else:
            x = np.unique(self.a[first : last + 1])
            shared, size = distinct_in_windows(self.b, np.isin(self.b, x), self.length), len(x)
        rest = size + self.whole_b - shared
        share = shared / rest
        low = int(share.argmax())
        return (low, low + self.length - 1, float(share[low])) if 100 * shared[low] >= self.percent * (rest[low]) else None


def middle(x: np.ndarray) -> int:
    return int(np.partition(x, len(x) // 2)[len(x) // 2])


def matching(a: np.ndarray, b: np.ndarray, length: int, percent: int, shift: int | None = None) -> list[tuple[int, int, int, int, float]]:
    """Stretches of a (first and last shingle) with those of b that they repeat, and their similarity; a place of a is about `shift` less than that in b."""
    if len(a) < length or len(b) < length:
        return []
    places = Places(a, b, length, percent, shift)
    starts = places.starts()
    out: list[tuple[int, int, int, int, float]] = []
    taken = -1

    def whole(some: np.ndarray) -> bool:
        nonlocal taken
        first, last = int(some[0]), int(some[-1]) + length - 1
        found = places.partner(first, last) or (places.anywhere(first, last) if len(some) == 1 else None)
        if found:
            out.append((first, last, *found))
            taken = last
        return found is not None

    for run in np.split(starts, np.flatnonzero(np.diff(starts) > length) + 1) if len(starts) else []:
        run = run[run > taken]
        if not len(run) or whole(run) or len(run) == 1:
            continue
        for part in np.split(run, np.flatnonzero(np.diff(run) > 1) + 1):  # stretches without a gap, or else their windows apart
            part = part[part > taken]
            if not len(part) or whole(part) or len(part) == 1:
                continue
            for one in part:
                if one > taken:
                    whole(np.array([one]))
    return out


def matching_within(a: np.ndarray, length: int, percent: int) -> list[tuple[int, int, int, int, float]]:
    """As `matching`, for stretches that repeat an earlier one of the same text, which they do not overlap."""
    own = np.sort(a)
    if len(a) < 2 * length or 100 * int((own[1:] == own[:-1]).sum()) < percent * length:  # too few occur before
        return []
    _, index, code = np.unique(a, return_index=True, return_inverse=True)
    new = np.append(0, np.cumsum(index[code] == np.arange(len(a))))
    distinct = distinct_in_windows(a, np.ones(len(a), bool), length)
    starts = np.flatnonzero(100 * (distinct - new[length:] + new[:-length]) >= percent * distinct)
    starts = starts[starts >= length]
    out = []
    for run in np.split(starts, np.flatnonzero(np.diff(starts) > length) + 1) if len(starts) else []:
        first, last = int(run[0]), int(run[-1]) + length
        found = [(first + x, first + y, *rest) for x, y, *rest in matching(a[first:last], a[:first], length, percent)]
        free = np.ones(last - first, bool)
        for x, y, *_ in found:
            free[x - first : y + 1 - first] = False
        for j in run.tolist():
            if free[j - first : j - first + length].all() and (alone := matching(a[j : j + length], a[:j], length, percent)):
                found.append((j, j + length - 1, *alone[0][2:]))
                free[j - first : j - first + length] = False
        out += found
    return out


def one_text_each(texts: DataFrame) -> DataFrame:
    """(id, text) with the smallest text of each id; only rows whose id repeats are shuffled with their text."""
    repeated = stored(texts.groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
    least = texts.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return texts.join(repeated, "id", "left_anti").union(least)


PASSAGES = "doc_id long, start_word long, n_words long, source_id long, source_word long, source_words long, similarity double"
FOUND = f"{PASSAGES}, node long, other long"


def compared(pairs: DataFrame | None, found: DataFrame, width: int, length: int, percent: int, earlier: bool = False) -> DataFrame:
    """FOUND of pairs of spans, the later one as node (or the earlier one); or of each span within itself, if no pairs are given."""
    data = found.select("node", "id", "start", F.col("low").alias("data"))
    both = data
    if pairs is not None:
        other = found.select(F.col("node").alias("other"), F.col("id").alias("other_id"), F.col("start").alias("other_start"), F.col("low").alias("other_data"))
        both = pairs.join(data, "node").join(other, "other")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, PAIRS) for whole in batches for at in range(0, whole.num_rows, PAIRS)):
            rows = []
            for r in batch.to_pylist():
                id, start, data, node = own = r["id"], r["start"], r["data"], r["node"]
                if "other" in r:
                    own, other = sorted([own, (r["other_id"], r["other_start"], r["other_data"], r["other"])], key=lambda x: x[:2], reverse=not earlier)
                    (id, start, data, node), (source, before, other_data, partner) = own, other
                    repeats = matching(np.frombuffer(data, np.uint32), np.frombuffer(other_data, np.uint32), length, percent)
                else:
                    source, before, partner = id, start, node
                    repeats = matching_within(np.frombuffer(data, np.uint32), length, percent)
                for first, last, low, high, share in repeats:
                    rows.append((id, start + first, last - first + width, source, before + low, high - low + width, share, node, partner))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [x.split()[0] for x in FOUND.split(", ")])

    return both.mapInArrow(verified, FOUND)


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return one_text_each(texts.where("id is not null and text is not null"))


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, width: int = WIDTH,
) -> DataFrame:
    """Rows of PASSAGES, places in words: all pairs, so they grow with the square of a group's size."""
    length = min_words - width + 1
    found = spans(texts_of(docs, id_col, text_col), width, length, percent)
    copies, seeds = folded(found, length, percent)
    pairs = each_once(copies.union(all_with_all(seeds, seeds)))
    both = (compared(x, found, width, length, percent) for x in (pairs, None))
    return next(both).union(next(both)).drop("node", "other").distinct()


def passage_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, width: int = WIDTH,
) -> DataFrame:
    """Rows of PASSAGES and class_id, the smallest document reachable by links: as many as the passages, not their pairs."""
    length = min_words - width + 1
    found = spans(texts_of(docs, id_col, text_col), width, length, percent)
    copies, seeds = folded(found, length, percent)
    step = lambda pairs: stored(compared(pairs, found, width, length, percent), "found")
    tried = stored(each_once(copies.union(with_hubs(seeds))), "tried")
    links = step(tried)
    left = open_seeds(found, links, width, length, percent)
    more = stored(each_once(all_with_all(left, some_of_each(seeds, left))).join(tried, ["node", "other"], "left_anti"), "tried")
    tried, links = tried.union(more), links.union(step(more))
    classes = stored(documents_classes(links), "classes")
    own = found.select("node", F.col("id").alias("doc_id")).join(classes, "doc_id", "left").select("node", F.coalesce("class_id", "doc_id").alias("class"))
    still = found.join(left.select("node").distinct(), "node", "left_semi")
    rest = each_once(all_with_all(open_seeds(still, links, width, length, percent), seeds).union(across(seeds, own)))
    rest = step(stored(rest.join(tried, ["node", "other"], "left_anti"), "tried"))
    links, classes = links.union(rest), joined_classes(classes, rest)
    within = step(None)
    own = links.union(within)
    firsts = links.join(own.select(F.col("node").alias("other")).distinct(), "other", "left_anti")
    long = firsts.where(F.col("source_words") >= min_words)
    short = firsts.join(long.select("other").distinct(), "other", "left_anti").select("node", "other").distinct()
    own = own.union(stored(compared(short, found, width, length, percent, earlier=True), "earlier"))
    firsts = long.groupBy(F.col("source_id").alias("id"), F.col("source_word").alias("word")).agg(F.max(F.struct("source_words", "similarity", "doc_id", "start_word", "n_words")).alias("r"))
    firsts = firsts.select("id", "word", "r.source_words", "r.doc_id", "r.start_word", "r.n_words", "r.similarity")
    rows = own.drop("node", "other").union(firsts).distinct()
    return rows.join(classes, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))


def documents_classes(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("doc_id").alias("a"), F.col("source_id").alias("b"))).select(F.col("node").alias("doc_id"), F.col("component").alias("class_id"))


def joined_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes of documents after more links."""
    ends = links.select("doc_id", "source_id").distinct()
    for name in ("doc_id", "source_id"):
        of = classes.select(F.col("doc_id").alias(name), F.col("class_id").alias("of"))
        ends = ends.join(of, name, "left").withColumn(f"{name}_class", F.coalesce("of", name)).drop("of")
    both = stored(components(ends.select(F.col("doc_id_class").alias("a"), F.col("source_id_class").alias("b"))), "joined")
    new = both.select(F.col("node").alias("class_id"), "component")
    alone = both.select(F.col("node").alias("doc_id"), F.col("component").alias("class_id")).join(classes, "doc_id", "left_anti")
    return classes.join(new, "class_id", "left").select("doc_id", F.coalesce("component", "class_id").alias("class_id")).union(alone)
