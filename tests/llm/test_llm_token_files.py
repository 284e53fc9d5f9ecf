"""Wavelet files of token ids against the library and plain arrays."""

import io
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airmart.llm import queries, token_files, wavelet

PATH = public_tokenizers.path(queries.WORDS)


def written(ids, doc_ids, starts):
    out = io.BytesIO()
    size = wavelet.write_ids(out, np.array(ids, np.uint32), doc_ids, np.array(starts))
    assert size == len(out.getvalue())
    return wavelet.WaveletFile(out, size)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40) | st.sampled_from([2**16, 2**32 - 1]), max_size=200), st.integers(0, 220), st.integers(0, 220))
def test_queries_agree_with_plain_arrays(ids, a, b):
    wavelet_bits, wavelet.BLOCK_BITS = wavelet.BLOCK_BITS, 64
    try:
        file = written(ids, [None, 5], [0, 0])
    finally:
        wavelet.BLOCK_BITS = wavelet_bits
    assert file.all_ids().tolist() == ids and file.ids(a, b).tolist() == ids[a:b] and file.ids(0, 10**9).tolist() == ids
    for token in {*ids[:5], 0, 41, 2**20}:
        want = [k for k in range(a, min(b, len(ids))) if ids[k] == token]
        assert file.count(token, a, b) == len(want) and file.positions(token, a, b).tolist() == want
        assert file.count(token) == ids.count(token)
    assert file.documents().ids == [None, 5]


def test_large_file_of_several_blocks():
    rng = np.random.default_rng(4)
    ids = (rng.zipf(1.3, 1_300_000) % 49408).astype(np.uint32)
    file = written(ids, [3], [0])
    assert (file.all_ids() == ids).all() and (file.ids(524_000, 525_000) == ids[524_000:525_000]).all()
    for token in (1, 2, 777, 49_407):
        assert (file.positions(token, 1000, 1_200_000) == 1000 + np.flatnonzero(ids[1000:1_200_000] == token)).all()
    with pytest.raises(ValueError):
        wavelet.WaveletFile(io.BytesIO(b"x" * 200), 200)


def brute(rows):
    """Contract rows for (doc_id, text)."""
    library, out, start = Tokenizer.from_file(PATH), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_all_documents(spark, sf01):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf01, "documents").collect()]
    assert sorted(tuple(r) for r in queries.op12_token_files(spark, sf01).collect()) == brute(rows)


def test_odd_texts_and_several_shards(spark, tmp_path, odd_texts):
    texts = [None, *odd_texts, "<|endoftext|> x <|startoftext|>y", "it's we'll a b1c22", "a ́b ́", "ΑΣ ΑΣ. Σ", " x   y", "12 34 !! a!!b"]
    rows = [(1000 - k, t) for k, t in enumerate(texts)] + [(None, "none"), (None, None), (7, "twice"), (7, "twice"), (7, "other"), (2**40, "wide " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("file", F.lit(1)).repartition(5)
    shards = token_files.write_shards(df, f"file://{tmp_path}/t", PATH, 2, shard_ids=500)
    assert sorted(map(str, map(tuple, token_files.read_documents(shards).collect()))) == sorted(map(str, brute(rows)))
    assert shards.count() > 4 and shards.agg(F.sum("n_docs")).first()[0] == len(rows)
    token = Tokenizer.from_file(PATH).encode("wide", add_special_tokens=False).ids[0]
    one = token_files.find(shards, token).where("doc_id = 1099511627776").first()
    assert one.n_found == 20_000 and one.places == list(range(20_000))
    assert token_files.find(shards, 49_000_000).count() == 0


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read_documents(token_files.write_shards(df, f"{tmp_path}/t", PATH, 2)).count() == 0


def test_reading_spreads_over_the_shards(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 50).alias("text"))
    shards = token_files.write_shards(df, f"{tmp_path}/t", PATH, 2, shard_ids=3000)
    assert 8 < shards.count() == token_files.spread(shards).rdd.getNumPartitions()


def test_texts_are_cut_only_under_known_rules():
    rules = json.load(open(PATH))
    assert token_files.splits_words(rules)
    assert not token_files.splits_words(json.load(open(public_tokenizers.path("byte_bpe_50k.json"))))
    for change in ({"pre_tokenizer": None}, {"normalizer": {"normalizers": [{"type": "Prepend", "prepend": "x"}]}}, {"post_processor": {"type": "x"}}):
        assert not token_files.splits_words(rules | change)
    whole = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids, counts = whole.ids(pa.array(["a b", None, "  c"]))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids.tolist() == [i for t in ("a b", "", "  c") for i in library.encode(t, add_special_tokens=False).ids] and counts.sum() == len(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abSTré'’s!=,.1²９_- \n\t\x0b\x1c\x85\xa0\u0301\u0338\u200dΣσ—日😀İſK<|>") | st.characters(exclude_categories=["Cs"]), max_size=25) | st.sampled_from(["<|endoftext|>", "it's we'LL", "a'sb'T", "<|ENDOFTEXT|>"]), max_size=4))
def test_any_text_has_the_ids_of_the_library(parts):
    own, text = token_files.encoder(PATH), "".join(parts)
    ids, counts = own.ids(pa.array([text, "x", text]))
    want = own.library.encode(text, add_special_tokens=False).ids
    one = own.library.encode("x", add_special_tokens=False).ids
    assert ids.tolist() == want + one + want and counts.tolist() == [len(want), 1, len(want)]


def test_segments_kept_are_bounded(monkeypatch):
    own = token_files.Encoder(PATH)
    monkeypatch.setattr(token_files, "KNOWN_SEGMENTS", 10)
    for k in range(5):
        text = " ".join(f"w{chr(97 + k)}{chr(97 + j)}" for j in range(20))
        assert own.ids(pa.array([text]))[0].tolist() == own.library.encode(text, add_special_tokens=False).ids
        assert len(own.known) <= 40
