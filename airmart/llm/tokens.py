"""Token counts of texts.

`count_tokens(texts, path)` is a column expression; it returns lengths only, no
ids. Texts are cut where no token can reach across, so that a very long text is
many short pieces, and the pieces of a batch are encoded in batches of equal
bytes. A piece that repeats within a batch is encoded once.

SentencePiece models: the cut is a single space between two characters that are
neither a space nor the marker U+2581. The space itself is left out, as the
model's own prefix puts it back. This holds if no piece of the vocabulary has
the marker after another character, spaces are kept as they are and the
normaliser is the identity; otherwise texts are encoded whole.
Tokenizers files (.json): texts are encoded whole.

A null text counts as empty: 0 bytes and 0 tokens. Rows, columns and repeated
rows stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from airmart.llm.model_file import read_model
from airmart.llm.segments import Segments, balanced, slices

BATCH_SIZE = 1 << 20


class SentencePieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.apart = read_model(path).splits_at_spaces()

    def counts(self, texts: pa.Array) -> np.ndarray:
        cut = Segments(texts, self.apart)
        lengths = [len(ids) for batch in balanced(cut.distinct, BATCH_SIZE) for ids in self.encoder.encode(batch, num_threads=1)]
        return cut.sums(np.array(lengths, np.int64))


class JsonCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.no_truncation()
        self.encoder.no_padding()

    def counts(self, texts: pa.Array) -> np.ndarray:
        batches = balanced(texts.fill_null("").to_pylist(), BATCH_SIZE)
        return np.array([len(e) for b in batches for e in self.encoder.encode_batch_fast(b, add_special_tokens=False)], np.int64)


@cache
def counter(path: str) -> SentencePieceCounter | JsonCounter:
    return SentencePieceCounter(path) if path.endswith(".model") else JsonCounter(path)


def count_tokens(texts: str | Column, path: str) -> Column:
    """Number of tokens of each text, without begin, end or added special tokens."""

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for batch in batches:
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *map(own.counts, slices(batch))]))

    return lengths(texts)


def byte_length(texts: str | Column) -> Column:
    """UTF-8 bytes of each text; 0 for null."""
    return F.coalesce(F.octet_length(texts), F.lit(0)).cast("long")
