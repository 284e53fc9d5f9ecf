"""Collocations: phrases whose words occur together more often than apart.

A-Z count as a-z. Texts are split at `.,;:!?` and line ends into pieces, pieces at
blanks and tabs into words. Phrases are 2 to `LONGEST` consecutive words of a piece;
all counts are within a language (a null one is `und`), whole and exact.

1. Texts of a language are packed into batches of about `BATCH_BYTES`: the distinct
   words, and for each word its number (0 ends a piece). All later passes read these.
2. Each batch hashes every n-gram by prefix polynomials over its words' Rabin-Karp
   hashes, and sends every distinct fingerprint with its count and a pointer to one
   occurrence to the bucket of the fingerprint's leading bits. A bucket adds up and
   tells each batch the pointers of those that are frequent. One and two words go
   first; three and more only where all pairs of neighbours are frequent, since no
   phrase is more frequent than its parts. Fingerprints that collide add up, so
   nothing frequent is lost.
3. Batches resolve the pointers in their own text. Occurrences are compared word by
   word with the one pointed to, others of the same fingerprint are phrases of their
   own. Only these phrases become text, go to the bucket of their fingerprint, and are
   added up as text: here a collision cannot change any count.
4. Joins give each cut of a phrase the counts of its parts; scores are decimal.

Buckets are made in proportion to the words. Nothing is sent to all tasks, and the
driver learns only the number of words.

Null and empty texts have no words. A very long text is a batch alone. Repeated rows
count each. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from airmart.llm.words import Spans, mixed, text_bytes
from airmart.session import materialize

LONGEST, AT_LEAST, FACTOR, FIRST = 5, 100, 1000, 2000
BATCH_BYTES, HELD_BYTES = 8 << 20, 24 << 20
BUCKET_WORDS = 2 << 20
NO_LANG = "und"
SALTS = 32


@cache
def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case byte, 0 in a word, 1 between words and 2 between pieces, code of a byte."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.zeros(256, np.uint8)
    kind[[0x20, 0x09]] = 1
    kind[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
    return lower, kind, mixed(np.arange(1, 257, dtype=np.uint64))


def coded(texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of texts, and the number of each word (from 1) in order with 0 after each piece."""
    lower, classes, _ = _classes()
    data, off = text_bytes(texts)
    inside = classes[data] == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        return [], np.zeros(0, np.uint32)
    breaks = np.flatnonzero((classes[data] == 2) | edge[:-1])
    piece = np.searchsorted(breaks, start, side="right")
    ends = np.append(0, np.cumsum(end - start)).astype(np.int64)
    flat = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(lower[data[inside]])])
    found = flat.dictionary_encode()
    numbers = found.indices.to_numpy().astype(np.uint32) + np.uint32(1)
    return found.dictionary.to_pylist(), np.insert(np.append(numbers, np.uint32(0)), np.flatnonzero(np.diff(piece)) + 1, np.uint32(0))


class Batch:
    """Words and word numbers of a batch, and the fingerprints of its n-grams."""

    def __init__(self, lang: str, words: bytes, numbers: bytes):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        flat = unpack.decompress(words)
        data = np.frombuffer(flat, np.uint8)
        space = np.flatnonzero(data == 32)
        start, end = np.append(0, space + 1), np.append(space, len(data))
        self._flat, self._at = flat, (start, end)
        own = Spans(data, _classes()[2]).hash(start, end)
        planes = np.frombuffer(unpack.decompress(numbers), np.uint8).reshape(4, -1)
        self.numbers = np.ascontiguousarray(planes.T).view("<u4").ravel()
        self.spans = Spans(self.numbers, np.append(np.uint64(0), own))
        borders = np.flatnonzero(self.numbers == 0)
        self.left = borders[np.searchsorted(borders, np.arange(len(self.numbers)))] - np.arange(len(self.numbers))  # words up to the end of the piece
        self.salt = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")

    @staticmethod
    def packed(words: list[bytes], numbers: np.ndarray) -> tuple[bytes, bytes]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
        return press.compress(b" ".join(words)), press.compress(np.ascontiguousarray(planes).tobytes())

    def fingerprints(self, n: int, at: np.ndarray) -> np.ndarray:
        return self.spans.hash(at, at + n) ^ mixed(np.array([self.salt + n & (1 << 64) - 1], np.uint64))

    def places(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.left >= n)

    def frequent(self, n: int, pointers: np.ndarray) -> np.ndarray:
        """Sorted fingerprints of the n-grams pointed to."""
        return np.sort(self.fingerprints(n, pointers))

    def phrase(self, n: int, at: int) -> str:
        start, end = self._at
        return b" ".join(self._flat[start[k - 1] : end[k - 1]] for k in self.numbers[at : at + n].tolist()).decode()

    def counted(self, n: int, pointers: np.ndarray) -> Iterator[tuple[int, int]]:
        """One place and the number of occurrences of each n-gram with a fingerprint of those pointed to, compared word by word."""
        if not len(pointers):
            return
        at = self.places(n)
        keys = self.fingerprints(n, at)
        known, one = np.unique(self.fingerprints(n, pointers), return_index=True)
        own = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        on = known[own] == keys
        at, own = at[on], own[on]
        model = pointers[one][own]
        same = np.ones(len(at), bool)
        for k in range(n):
            same &= self.numbers[at + k] == self.numbers[model + k]
        yield from zip(pointers[one].tolist(), np.bincount(own[same], minlength=len(known)).tolist())
        others: dict[bytes, list[int]] = defaultdict(list)
        for place in at[~same].tolist():
            others[self.numbers[place : place + n].tobytes()].append(place)
        yield from ((places[0], len(places)) for places in others.values())


BATCHES = "batch string, lang string, n_words long, words binary, numbers binary"


def batches_of(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Texts packed by language, one row for each batch."""
    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: dict[str, list[pa.Array]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            sizes.pop(lang)
            words, numbers = coded(pa.concat_arrays(held.pop(lang)))
            if words:
                number += 1
                yield pa.RecordBatch.from_pylist([dict(zip(names, (f"{part}-{number}", lang, int(np.count_nonzero(numbers)), *Batch.packed(words, numbers))))], schema)

        for row in rows:
            langs, texts = row.column("lang").dictionary_encode(), row.column("text").fill_null("").cast(pa.large_string())
            sizes_of = pc.binary_length(texts).to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = np.flatnonzero(langs.indices.to_numpy() == k)
                ends, at = np.cumsum(sizes_of[own]), 0
                while at < len(own):
                    base = int(ends[at] - sizes_of[own[at]])
                    to = min(len(own), at + 1 + int(np.searchsorted(ends[at:] - base, batch_bytes - sizes[lang])))
                    held[lang].append(texts.take(pa.array(own[at:to])))
                    sizes[lang] += int(ends[to - 1]) - base
                    at = to
                    if sizes[lang] >= batch_bytes:
                        yield from flush(lang)
                while sum(sizes.values()) > HELD_BYTES:
                    yield from flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from flush(lang)

    names = [x.split()[0] for x in BATCHES.split(", ")]
    schema = pa.schema([("batch", pa.string()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.binary()), ("numbers", pa.binary())])
    own = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    return own.mapInArrow(pack, BATCHES)


# -- fingerprints to buckets and back --------------------------------------

SENT = "bucket long, batch string, keys binary, counts binary, sizes binary, places binary"
TOLD = "batch string, sizes binary, places binary"


def sent(batch: str, bits: int, sizes: list[int], grams: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row for each bucket: distinct fingerprints, their counts, lengths and first places."""
    key, count, place = (np.concatenate([np.zeros(0, kind), *[g[k] for g in grams]]).astype(kind) for k, kind in ((0, np.uint64), (2, np.uint32), (1, np.uint32)))
    size = np.repeat(np.array(sizes, np.uint8), [len(g[0]) for g in grams])
    bucket = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
    order = np.argsort(bucket, kind="stable")
    key, count, place, size, bucket = (x[order] for x in (key, count, place, size, bucket))
    found, first = np.unique(bucket, return_index=True)
    cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first, np.append(first[1:], len(x)))], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array([batch] * len(found), pa.string()), *map(cut, (key, count, size, place))], ["bucket", "batch", "keys", "counts", "sizes", "places"])


def distinct(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, first, count = np.unique(keys, return_index=True, return_counts=True)
    return found, at[first], count


def pointers(told: pa.Table | None, n: int) -> np.ndarray:
    """Places of n-grams that buckets told a batch."""
    if told is None or not len(told):
        return np.zeros(0, np.int64)
    size = np.frombuffer(b"".join(told.column("sizes").to_pylist()), np.uint8)
    return np.frombuffer(b"".join(told.column("places").to_pylist()), np.uint32)[size == n].astype(np.int64)


def tell(grams: DataFrame, at_least: int) -> DataFrame:
    """Lengths and places, for each batch, of fingerprints that occur often enough."""
    def add_up(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()]
        count = np.frombuffer(b"".join(group.column("counts").to_pylist()), np.uint32).astype(np.int64)
        _, code = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(code.max() + 1, np.int64)
        np.add.at(total, code, count)
        often = np.split(total[code] >= at_least, np.cumsum([len(k) for k in keys])[:-1])
        chosen = lambda name, kind: pa.array([np.frombuffer(x, kind)[on].tobytes() for x, on in zip(group.column(name).to_pylist(), often)], pa.binary())
        told = pa.table({"batch": group.column("batch"), "sizes": chosen("sizes", np.uint8), "places": chosen("places", np.uint32)})
        return told.filter(pa.array([bool(on.any()) for on in often]))

    return grams.groupBy("bucket").applyInArrow(add_up, TOLD)


def short_grams(batches: DataFrame, bits: int) -> DataFrame:
    """Fingerprints of all words and pairs."""
    def post(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for r in row.to_pylist():
                own = Batch(r["lang"], r["words"], r["numbers"])
                at = own.places(1)
                _, first, count = np.unique(own.numbers[at], return_index=True, return_counts=True)
                single = own.fingerprints(1, at[first]), at[first], count
                pairs = own.places(2)
                yield sent(r["batch"], bits, [1, 2], [single, distinct(own.fingerprints(2, pairs), pairs)])

    return batches.mapInArrow(post, SENT)


def long_grams(batches: DataFrame, told: DataFrame, bits: int, longest: int) -> DataFrame:
    """Fingerprints of three words and more of which all neighbours are frequent pairs."""
    def post(own: pa.Table, told: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], t) for c, t in (("bucket", pa.int64()), ("batch", pa.string()), *((c, pa.binary()) for c in ("keys", "counts", "sizes", "places")))})
        if not len(own) or not len(told):
            return empty
        r = own.to_pylist()[0]
        batch = Batch(r["lang"], r["words"], r["numbers"])
        often = batch.frequent(2, pointers(told, 2))
        if not len(often):
            return empty
        pairs = batch.places(2)
        keys = batch.fingerprints(2, pairs)
        pair = np.zeros(len(batch.numbers) + longest, bool)
        pair[pairs] = often[np.minimum(np.searchsorted(often, keys), len(often) - 1)] == keys
        at, grams = np.flatnonzero(pair), []
        for n in range(3, longest + 1):
            at = at[pair[at + n - 2]]
            grams.append(distinct(batch.fingerprints(n, at), at))
        return pa.Table.from_batches([sent(r["batch"], bits, list(range(3, longest + 1)), grams)]) if any(len(g[0]) for g in grams) else empty

    return batches.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(post, SENT)


FOUND = "bucket long, lang string, phrases array<string>, sizes array<int>, counts array<long>"


def phrases(batches: DataFrame, told: DataFrame, bits: int, longest: int) -> DataFrame:
    """Text, words and count within its batch of every n-gram that buckets told; one row for each batch and bucket."""
    def resolve(own: pa.Table, told: pa.Table) -> pa.Table:
        rows: list[dict] = []
        if len(own) and len(told):
            r = own.to_pylist()[0]
            batch = Batch(r["lang"], r["words"], r["numbers"])
            found: dict[int, tuple[list, list, list]] = defaultdict(lambda: ([], [], []))
            for n in range(1, longest + 1):
                counted = list(batch.counted(n, pointers(told, n)))
                keys = batch.fingerprints(n, np.array([at for at, _ in counted], np.int64))
                for (at, count), bucket in zip(counted, (keys >> np.uint64(64 - bits) if bits else keys * np.uint64(0)).tolist()):
                    for column, value in zip(found[bucket], (batch.phrase(n, at), n, count)):
                        column.append(value)
            rows = [{"bucket": k, "lang": r["lang"], "phrases": p, "sizes": n, "counts": c} for k, (p, n, c) in found.items()]
        return pa.Table.from_pylist(rows, schema)

    schema = pa.schema([("bucket", pa.int64()), ("lang", pa.string()), ("phrases", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
    return batches.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(resolve, FOUND)


def added_up(found: DataFrame, at_least: int) -> DataFrame:
    """(lang, phrase, n_words, n): counts of equal phrases of all batches, where there are enough."""
    def add_up(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        owner = pc.list_parent_indices(group.column("phrases"))
        flat = pa.table({"lang": group.column("lang").take(owner), "phrase": pc.list_flatten(group.column("phrases")), "n_words": pc.list_flatten(group.column("sizes")), "n": pc.list_flatten(group.column("counts"))})
        total = flat.group_by(["lang", "phrase", "n_words"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
        return total.filter(pc.greater_equal(total.column("n"), at_least)).select(["lang", "phrase", "n_words", "n"])

    return found.groupBy("bucket").applyInArrow(add_up, "lang string, phrase string, n_words int, n long")


def frequent_phrases(batches: DataFrame, longest: int = LONGEST, at_least: int = AT_LEAST) -> DataFrame:
    """(lang, phrase, n_words, n): all phrases of 1 to `longest` words that occur often enough in a language."""
    words = batches.agg(F.sum("n_words")).first()[0] or 0
    bits = max(0, (words // BUCKET_WORDS).bit_length())
    short = materialize(tell(short_grams(batches, bits), at_least), "short-pointers")
    told = short
    if longest > 2:
        told = short.union(materialize(tell(long_grams(batches, short, bits, longest), at_least), "long-pointers"))
    return added_up(phrases(batches, told, bits, longest), at_least)


# -- scores ----------------------------------------------------------------


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, at_least: int = AT_LEAST, first: int = FIRST, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """The first phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    a occurrences; the cut into l and r of its parts that scores lowest, floor(1000 a n /
    (l r)) with n words in the language, ties to the shortest first part. A phrase
    inside a longer one that occurs as often is left out.
    """
    batches = materialize(batches_of(docs, lang_col, text_col, batch_bytes), "batches")
    counts = materialize(frequent_phrases(batches, longest, at_least), "phrases")
    words = batches.groupBy("lang").agg(F.sum("n_words").alias("n"))
    found = counts.where("n_words > 1").select("lang", "phrase", "n_words", F.col("n").alias("a"))
    return ranked(without_parts(scored(found, counts, words)), first)


def scored(found: DataFrame, counts: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases (lang, phrase, n_words, a) with l, r, n and score of their lowest cut."""
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - n_words)")})
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    parts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(words, "lang")
    # Decimals hold products of counts exactly; a score is at most 10 n.
    score = F.expr("cast((cast(a as decimal(19, 0)) * cast(n as decimal(19, 0)) * 1000) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as bigint)")
    low = parts.groupBy("lang", "phrase", "n_words", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low"))
    return low.select("lang", "phrase", "n_words", "a", "low.l", "low.r", "n", "low.score")


def without_parts(found: DataFrame) -> DataFrame:
    """Phrases that lie in no longer one that occurs as often."""
    longer = found.where("n_words > 2").select("lang", "a", F.split("phrase", " ").alias("w"), "n_words")
    spans = "flatten(transform(sequence(2, n_words - 1), s -> transform(sequence(1, n_words - s + 1), i -> array_join(slice(w, i, s), ' '))))"
    inner = longer.select("lang", F.explode(F.expr(spans)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("whole"))
    return found.join(inner, ["lang", "phrase"], "left").where("whole is null or whole < a").drop("whole")


def ranked(found: DataFrame, first: int) -> DataFrame:
    """The first of each language; ranked within slices before, so that one task sees a bounded number of rows of a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for keys in (["lang", "_salt"], ["lang"]):
        if "_salt" in keys:
            found = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= first)
    return found.select("lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "l", "r", "n", "score")
