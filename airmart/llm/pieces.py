"""SentencePiece encoding and decoding with the tokenizers library.

`build_tokenizer` reads the model file and rebuilds it: normaliser (character
map, spaces, prefix, marker), unigram scores or ranked merges, byte fallback and
decoder. `encode` and `decode` are column expressions that work on Arrow batches
with several threads each. Encoding compares the ids of every distinct segment,
and what they decode to, with the sentencepiece library and fails where they
differ; a worker remembers up to `VERIFIED` segments that it has compared.

Where no token reaches over a space (see Model.splits_at_spaces) words are
encoded apart, which gives the same ids and lets the tokenizer remember words.

A null text is encoded as null, as is a decoded null; an empty text has no ids.
Repeated rows and other columns stay as they are. Text that holds the strings of
control or byte pieces is ordinary text. An id outside the vocabulary is an error.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from airmart.llm.model_file import BPE, BYTE, CONTROL, MARK, NORMAL, UNIGRAM, Model, USER_DEFINED, read_model
from airmart.llm.segments import Segments, balanced, slices

THREADS = 2
VERIFIED, AT_ONCE = 1 << 19, 1 << 13  # segments a worker remembers to have compared, and compares at a time
BATCH_SIZE, SLICE_BYTES = 1 << 20, 4 << 20
TOGETHER = 64


def build_tokenizer(model: Model):
    """A tokenizers.Tokenizer with the behaviour of the model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if any(p.kind == USER_DEFINED for p in model.pieces) or model.suffix_space:
        raise ValueError("user-defined pieces and space as suffix are not supported")
    unknown = model.unknown_id()
    if model.kind == UNIGRAM:
        # Control pieces never match text, as no blank is left in normalised text. Byte pieces
        # keep their names, by which unknown characters fall back to them.
        lowest = min(p.score for p in model.pieces if p.kind == NORMAL)
        named = [p.text if p.kind in (NORMAL, BYTE) else f" {p.text}" for p in model.pieces]
        scored = [(t, p.score if p.kind == NORMAL else lowest - 1e4) for t, p in zip(named, model.pieces)]
        own = models.Unigram(scored, unknown, model.byte_fallback)
    elif model.kind == BPE:
        own = models.BPE(
            {p.text: i for i, p in enumerate(model.pieces)}, merges(model), unk_token=model.pieces[unknown].text,
            fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"model type {model.kind} is not supported")
    tokenizer = Tokenizer(own)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.strip_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.splits_at_spaces():
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if not model.byte_fallback:
        back.insert(0, decoders.Replace(model.pieces[unknown].text, model.unknown_surface))
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


def merges(model: Model) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece, the best scored piece first."""
    rank = {p.text: (-p.score, i) for i, p in enumerate(model.pieces) if p.kind == NORMAL}
    found = []
    for text, order in rank.items():
        for cut in range(1, len(text)):
            left, right = text[:cut], text[cut:]
            if left in rank and right in rank:
                found.append((order, rank[left], rank[right], (left, right)))
    return [pair for *_, pair in sorted(found)]


class Codec:
    """Encodes and decodes batches; each distinct word of a batch once, where words are apart."""

    def __init__(self, path: str, threads: int = THREADS):
        from tokenizers import normalizers, pre_tokenizers

        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))  # read when the first batch is encoded
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        self.path, self.model = path, read_model(path)
        self.tokenizer = build_tokenizer(self.model)
        self.apart = self.model.splits_at_spaces()
        self.control = {i for i, p in enumerate(self.model.pieces) if p.kind == CONTROL}
        # In a unigram model the name of a byte piece could be matched as text; such texts, which
        # are rare, are encoded by the library.
        self.byte_names = self.model.kind == UNIGRAM and self.model.byte_fallback
        self.bare = self.tokenizer
        if self.apart:
            self.bare = build_tokenizer(self.model)
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([])
            self.marked = np.array([p.text.startswith(MARK) for p in self.model.pieces])
        self.verified = np.zeros(0, np.uint64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where those of each text begin (one more for the end)."""
        return self.encode_parts(texts, False)[:2]

    def encode_parts(self, texts: pa.Array, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As encode(), with whether each text decodes to its normal form if `back`."""
        cut = Segments(texts, self.apart)
        own, starts = self.encode_distinct(cut.distinct)
        lengths = np.diff(starts)[cut.code]
        ends = np.cumsum(lengths)
        ids = own[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[cut.code] - ends + lengths, lengths)]
        offsets = np.append(0, ends)[cut.first]
        self.verify(cut.distinct, cut.keys, own, starts)
        same = cut.sums(~self.decode_back(cut.distinct, own, starts)) == 0 if back else np.ones(len(texts), bool)
        return ids, offsets, same

    def encode_distinct(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.apart:
            ids = [e.ids for batch in balanced(parts, BATCH_SIZE) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
            ids = [self.library.encode(p) if self.byte_names and "<0x" in p else own for p, own in zip(parts, ids)]
            starts = np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))))
            return np.fromiter(chain.from_iterable(ids), np.int32, int(starts[-1])), starts
        # Many words are one input. The normaliser of such models only puts the
        # marker before each word, and each word's first id is the only one that has it.
        named = [self.byte_names and "<0x" in p for p in parts]
        plain = [MARK + p if p and " " not in p and MARK not in p and not n else "" for p, n in zip(parts, named)]
        inputs = ["".join(plain[i : i + TOGETHER]) for i in range(0, len(plain), TOGETHER)]
        flat = self.flat_ids(inputs)
        heads = np.append(np.flatnonzero(self.marked[flat]), len(flat))
        sizes = np.zeros(len(parts), np.int64)
        sizes[np.fromiter(map(bool, plain), bool, len(plain))] = np.diff(heads)
        odd = [i for i, p in enumerate(plain) if not p and parts[i]]
        if not odd:
            return flat, np.append(0, np.cumsum(sizes))
        own = [e.ids for e in self.bare.encode_batch_fast([MARK + parts[i].replace(" ", MARK) for i in odd], add_special_tokens=False)]
        own = [self.library.encode(parts[i]) if named[i] else x for i, x in zip(odd, own)]
        place = np.append(0, np.cumsum(sizes))[odd]
        sizes[odd] = list(map(len, own))
        return np.insert(flat, np.repeat(place, sizes[odd]), list(chain.from_iterable(own))), np.append(0, np.cumsum(sizes))

    def flat_ids(self, inputs: list[str]) -> np.ndarray:
        found = [np.array(e.ids, np.int32) for batch in balanced(inputs, BATCH_SIZE) for e in self.bare.encode_batch_fast(batch, add_special_tokens=False)]
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def decode_back(self, parts: list[str], own: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether each part decodes to its normal form; parts that meet at spaces are decoded many together."""
        step = TOGETHER if self.apart else 1
        groups = range(0, len(parts), step)
        found = self.decode([own[starts[i] : starts[min(i + step, len(parts))]].tolist() for i in groups])
        right = np.ones(len(parts), bool)
        for i, text in zip(groups, found):
            if text != " ".join(p for p in map(self.normal, parts[i : i + step]) if step == 1 or p):
                lists = [own[a:b].tolist() for a, b in zip(starts[i : i + step], starts[i + 1 : i + step + 1])]
                right[i : i + step] = [a == self.normal(p) for a, p in zip(self.decode(lists), parts[i : i + step])]
        return right

    def normal(self, text: str) -> str:
        """What the ids of a text decode to."""
        if not self.model.charsmap and not self.model.strip_spaces:
            return text.replace(MARK, " ")
        text = self.tokenizer.normalizer.normalize_str(text).replace(MARK, " ")
        return text[1:] if self.model.dummy_prefix else text

    def decode(self, ids: list[list[int]]) -> list[str]:
        size = len(self.model.pieces)
        if any(x and (max(x) >= size or min(x) < 0) for x in ids):
            raise ValueError(f"an id is outside the vocabulary of {size}")
        # As in the library, control pieces have no text.
        ids = [[i for i in x if i not in self.control] if self.control.intersection(x) else x for x in ids]
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    @cached_property
    def library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path)

    def verify(self, parts: list[str], keys: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> None:
        """Compare every segment that this worker has not compared before with the library, both ways; keys are their hashes."""
        new = np.flatnonzero(~np.isin(keys, self.verified)).tolist()
        for at in range(0, len(new), AT_ONCE):
            own = [ids[starts[i] : starts[i + 1]].tolist() for i in new[at : at + AT_ONCE]]
            texts = [parts[i] for i in new[at : at + AT_ONCE]]
            for text, found, other in zip(texts, own, self.library.encode(texts, num_threads=1)):
                if found != other:
                    raise ValueError(f"the rebuilt tokenizer differs from {self.path} on {text[:80]!r}")
            for text, back, other in zip(texts, self.decode(own), self.library.decode(own, num_threads=1)):
                if back != other:
                    raise ValueError(f"the rebuilt decoder differs from {self.path} on {text[:80]!r}")
        # Hashes, as segments themselves would take ten times the memory.
        self.verified = np.union1d(self.verified if len(self.verified) < VERIFIED else self.verified[:0], keys)


@cache
def codec(path: str, threads: int = THREADS) -> Codec:
    return Codec(path, threads)


def id_lists(ids: np.ndarray, offsets: np.ndarray, nulls: np.ndarray) -> pa.Array:
    """Lists as one Arrow array; null where `nulls` says so."""
    starts = pa.array(offsets.astype(np.int32), mask=np.append(nulls, False) if nulls.any() else None)
    return pa.ListArray.from_arrays(starts, pa.array(ids))


def encode(texts: str | Column, path: str, threads: int = THREADS) -> Column:
    """Ids of each text, without begin, end or other special pieces."""

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, threads)
        for batch in batches:
            found = [id_lists(*own.encode(part), np.asarray(part.is_null())) for part in slices(batch)]
            yield pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *found])

    return ids_of(texts)


def decode(ids: str | Column, path: str, threads: int = THREADS) -> Column:
    """Text of each list of ids."""

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, threads)
        for batch in batches:
            yield pa.array(own.decode([x or [] for x in batch.to_pylist()]), pa.string(), mask=np.asarray(batch.is_null()))

    return text_of(ids)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", threads: int = THREADS) -> DataFrame:
    """(id_col, n_tokens, round_trip, ids) of each row: the ids of its text, their number, and whether they decode to the text as the model normalises it.

    Rows leave in batches of a few megabytes of text, whatever the batches they come in,
    so a worker holds the ids of no more. A null text has null ids and no tokens.
    """
    own = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = own.schema[0].dataType.simpleString()

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, threads)
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), SLICE_BYTES):
                nulls = np.asarray(part.is_null())
                ids, offsets, same = coder.encode_parts(part, True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(np.diff(offsets)), pa.array(same, mask=nulls), id_lists(ids, offsets, nulls)],
                    [id_col, "n_tokens", "round_trip", "ids"],
                )
                at += len(part)

    return own.mapInArrow(encode_rows, f"`{id_col}` {kind}, n_tokens long, round_trip boolean, ids array<int>")
