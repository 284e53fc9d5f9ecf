"""Token ids of documents in files of wavelet matrices, in ascending order of ids.

`write_shards` range-partitions documents by id, encodes them with a tokenizers
file, appends an end id to each, and writes the ids of consecutive documents to
shards of about `SHARD_IDS` ids (wavelet.py); it returns the index of shards,
which is written before it is returned. `read_documents` opens the shards of an
index and gives each document's place and a digest of its ids, as the files have
them. `find` looks up an id in all shards. A shard is named by its task's attempt,
so what a lost task left is in no index.

If a file's rules are known to split texts into words (`splits_words`), encoding cuts
texts where such a split always is, and the library encodes each distinct segment
once; a worker keeps the ids of up to `KNOWN_SEGMENTS` of them. Otherwise, and where a
text holds the string of an added token, texts are encoded whole. Such strings are
handled as is the library's default; no special tokens are added.

A null text is empty: its document has the end id only. A null id comes first.
Rows that share an id are documents of their own, next to each other, by text.
A document is never cut: one longer than a shard is a shard alone. An empty table
has no shards and no rows. Extra columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from airmart.llm.segments import balanced, slices
from airmart.llm.warc import open_uri, store_of
from airmart.llm.wavelet import WaveletFile, write_ids
from airmart.llm.words import text_bytes
from airmart.session import materialize, scratch_path

SHARD_IDS = 1 << 24
BATCH_CHARS = 1 << 20
WORDS_AT_ONCE, KNOWN_SEGMENTS = 512, 1 << 19


# Fixed value: the split pattern of files whose words end in `</w>`.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


def splits_words(rules: dict) -> bool:
    """Whether a tokenizers file lowers case and splits texts by `WORD_PATTERN` alone."""
    split, *rest = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    steps = (rules["normalizer"] or {}).get("normalizers", [])
    return (
        split == {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
        and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        and [(r["type"], r["add_prefix_space"], r["use_regex"]) for r in rest] == [("ByteLevel", False, False)]
        and rules["post_processor"] is None and rules["model"].get("end_of_word_suffix") == WORD_END
    )


@cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case byte; and its kind: 0 white space, 1 letter, 2 beyond ASCII, 3 apostrophe, 4 others."""
    lower, kind = np.arange(256, dtype=np.uint8), np.full(256, 4, np.uint8)
    lower[65:91] += 32
    kind[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]], kind[128:], kind[0x27] = 0, 2, 3
    kind[65:91] = kind[97:123] = 1
    return lower, kind


def segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct segments in lower case (binary), which one each segment is, and how many each text has.

    Cut where the pattern ends a match whatever stands around: at ASCII white space, which
    is dropped, and between an ASCII letter and another ASCII character, but not after
    an apostrophe.
    """
    lower, kinds = _classes()
    data, off = text_bytes(texts)
    kind = kinds[data]
    cut = np.ones(len(data) + 1, bool)
    left, right = kind[:-1], kind[1:]
    cut[1:-1] = (left == 0) | (right == 0) | ((left == 1) & (right > 2)) | ((left == 4) & (right == 1))
    cut[off] = True
    inside = kind > 0
    start, end = np.flatnonzero(inside & cut[:-1]), np.flatnonzero(inside & cut[1:]) + 1
    ends = np.append(0, np.cumsum(end - start))
    flat = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(lower[data[inside]])])
    found = flat.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), np.diff(np.searchsorted(start, off))


class Encoder:
    """Ids of texts as the library gives them, with the ids of segments met before at hand."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        rules = json.loads(self.library.to_str())
        self.apart, self.added = splits_words(rules), [a["content"] for a in rules["added_tokens"]]
        self.forget()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for batch in balanced(texts, BATCH_CHARS) for e in self.library.encode_batch_fast(batch, add_special_tokens=False)]

    def forget(self) -> None:
        """Known segments, and the ids of each one after another."""
        self.known = pa.array([], pa.large_binary())
        self.known_ids, self.known_ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def places(self, distinct: pa.Array) -> np.ndarray:
        """Places of segments among the known ones, where new ones are put."""
        at = pc.index_in(distinct, value_set=self.known)
        if not at.null_count:
            return at.to_numpy()
        if len(self.known) and len(self.known) + at.null_count > KNOWN_SEGMENTS:
            self.forget()
            return self.places(distinct)
        absent = np.asarray(at.is_null())
        at = np.array(at.fill_null(0))
        at[absent] = len(self.known) + np.arange(np.count_nonzero(absent))
        new = distinct.filter(pa.array(absent))
        own = self.encoded(new.to_pylist())
        self.known = pa.concat_arrays([self.known, new])
        self.known_ends = np.append(self.known_ends, self.known_ends[-1] + np.cumsum([len(x) for x in own]))
        self.known_ids = np.concatenate([self.known_ids, *own])
        return at

    def encoded(self, new: list[bytes]) -> list[np.ndarray]:
        """Ids of segments. Words of letters go together, as each gives an id that ends a word, at its last or earlier.

        If there are as many such ids as words, each is the last of its word.
        """
        found: dict[bytes, np.ndarray] = {}
        words = [w for w in new if w.decode().isalpha()]
        for at in range(0, len(words), WORDS_AT_ONCE):
            own = words[at : at + WORDS_AT_ONCE]
            ids = self.whole([b" ".join(own).decode()])[0]
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == len(own):
                found.update(zip(own, (ids[a:b] for a, b in zip([0, *last[:-1].tolist()], last.tolist()))))
        rest = [w for w in new if w not in found]
        found.update(zip(rest, self.whole([w.decode() for w in rest])))
        return [found[w] for w in new]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        texts = texts.fill_null("")
        odd = np.full(len(texts), not self.apart)
        for content in self.added:  # their strings are looked for before anything else
            odd |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        distinct, code, n_segments = segments(plain)
        at = self.places(distinct)
        flat, first, length = self.known_ids, self.known_ends[at], self.known_ends[at + 1] - self.known_ends[at]
        n = length[code]
        ends = np.append(0, np.cumsum(n))
        found = flat[np.arange(ends[-1]) + np.repeat(first[code] - ends[:-1], n)]
        text_ends = ends[np.append(0, np.cumsum(n_segments))]
        counts = np.diff(text_ends)
        if odd.any():
            at = np.flatnonzero(odd)
            special = self.whole([texts[int(k)].as_py() for k in at])
            sizes = [len(x) for x in special]
            found = np.insert(found, np.repeat(text_ends[at], sizes), np.concatenate(special))
            counts[at] = sizes
        return found, counts


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1


class ShardWriter:
    """Collects documents and writes a shard whenever enough ids are there."""

    def __init__(self, folder: str, name: str, part: int, shard_ids: int):
        self.folder, self.name, self.part, self.shard_ids = folder.rstrip("/"), name, part, shard_ids
        self.ids, self.docs, self.counts, self.held, self.number = [], [], [], 0, 0

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        """Index rows of the shards that these documents fill."""
        ends, at = np.cumsum(counts), 0
        while at < len(doc_ids):
            base = int(ends[at] - counts[at])
            to = min(len(doc_ids), at + 1 + int(np.searchsorted(ends[at:] - base, self.shard_ids - self.held)))
            self.ids.append(ids[base : ends[to - 1]].astype(np.uint16 if ids.max() < 1 << 16 else np.uint32))
            self.docs += doc_ids[at:to]
            self.counts.append(counts[at:to])
            self.held += len(self.ids[-1])
            at = to
            if self.held >= self.shard_ids:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if self.docs:
            store, path = store_of(self.folder)
            store.create_dir(path, recursive=True)
            name = f"{self.name}-{self.number:05d}.idwm"
            counts = np.concatenate(self.counts)
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                size = write_ids(out, np.concatenate(self.ids), self.docs, np.cumsum(counts) - counts)
            yield f"{self.folder}/{name}", self.part, self.number, len(self.docs), self.held, size
            self.number += 1
            self.ids, self.docs, self.counts, self.held = [], [], [], 0


SHARDS = "file string, part int, number int, n_docs long, n_ids long, n_bytes long"


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes all documents below `folder` (a path or URI that all executors reach); one row for each shard."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own = TaskContext.get(), encoder(path)
        shard = ShardWriter(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}", task.partitionId(), shard_ids)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                ids, counts = with_end(*own.ids(texts), end_id)
                yield from as_batch(shard.add(batch.column("id").slice(at, len(texts)).to_pylist(), ids, counts))
                at += len(texts)
        yield from as_batch(shard.flush())

    def as_batch(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r))], schema)

    schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Rows of one id, however many, are spread by the task they come from.
    placed = own.withColumn("_task", F.spark_partition_id()).repartitionByRange(n, "id", "_task").sortWithinPartitions("id", "text", "_task")
    return materialize(placed.select("id", "text").mapInArrow(write, SHARDS), "shards")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files; `start` counts the ids of all documents before."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                with open_uri(path) as file:
                    shard = WaveletFile(file, file.size())
                    ids, docs = shard.all_ids().astype("<u4"), shard.documents()
                data, ends = memoryview(ids).cast("B"), docs.starts.tolist()
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs.ids, pa.int64()), pa.array(docs.starts[:-1] + before), pa.array(np.diff(docs.starts)), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One row for each shard, that is for millions of ids: few enough to order in one task.
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("file", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))
    return spread(shards, placed).mapInArrow(read, DOCUMENTS)


def spread(shards: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Shards (or rows that go with them) over as many tasks as there are, up to the session's partitions times four; a file is read by one task."""
    most = 4 * int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (shards.select("file") if rows is None else rows).repartition(max(1, min(most, shards.count())))


def find(shards: DataFrame, token: int) -> DataFrame:
    """(file, doc_id, n_found, places): documents that hold an id and where in them, by rank and select alone."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file").to_pylist():
                with open_uri(path) as file:
                    shard = WaveletFile(file, file.size())
                    docs, at = shard.documents(), shard.positions(token)
                own = np.searchsorted(docs.starts, at, side="right") - 1
                which, first, count = np.unique(own, return_index=True, return_counts=True)
                places = [(at[a : a + n] - docs.starts[d]).tolist() for d, a, n in zip(which, first, count)]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(which), pa.string()), pa.array([docs.ids[d] for d in which], pa.int64()), pa.array(count), pa.array(places, pa.list_(pa.int64()))], ["file", "doc_id", "n_found", "places"])

    return spread(shards).mapInArrow(look, "file string, doc_id long, n_found long, places array<long>")


def shard_folder(spark) -> str:
    """A new folder for shards below the shared scratch folder."""
    return scratch_path(spark, "token-files")
