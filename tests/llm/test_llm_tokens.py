"""SentencePiece codec and token counts against the libraries."""

import pyarrow as pa
import pytest
import sentencepiece
import public_tokenizers
from tokenizers import Tokenizer

from airmart.llm import pieces, queries, tokens
from airmart.llm.model_file import parse_model, read_model


def test_every_document_encodes_as_the_library_does(spark, sf01, model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = {r.doc_id: r.text for r in queries.table(spark, sf01, "documents").collect()}
    for r in queries.op1_sentencepiece(spark, sf01).collect():
        assert r.ids == library.encode(texts[r.doc_id])
        assert r.round_trip and r.n_tokens == len(r.ids)


def test_every_document_counts_as_the_library_does(spark, sf01, model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = {r.doc_id: r.text for r in queries.table(spark, sf01, "documents").collect()}
    found = queries.op10_token_counts(spark, sf01).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 4096)


def test_odd_texts_repeat_and_clash(spark, odd_texts, model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = [(i, t, i) for i, t in enumerate([*odd_texts, None, None, odd_texts[2]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long").repartition(3)
    got = df.select("doc_id", "ids", pieces.encode("text", model).alias("own"), tokens.count_tokens("text", model).alias("n"), "text")
    back = got.withColumn("back", pieces.decode("own", model)).collect()
    assert len(back) == len(rows)
    for r in back:
        if r.text is None:
            assert r.own is None and r.back is None and r.n == 0
        else:
            assert r.own == library.encode(r.text) and r.n == len(r.own) and r.back == library.decode(r.own)


def test_empty_table(spark, model):
    df = spark.createDataFrame([], "text string")
    assert df.select(pieces.encode("text", model), tokens.count_tokens("text", model)).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_json_tokenizers_count_as_the_library_does(spark, odd_texts, name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    df = spark.createDataFrame([(t + " <|endoftext|>",) for t in odd_texts], "text string")
    for r in df.select("text", tokens.count_tokens("text", path).alias("n")).collect():
        assert r.n == len(library.encode(r.text, add_special_tokens=False))


def field(number: int, data) -> bytes:
    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    return varint(number << 3) + varint(data) if isinstance(data, int) else varint(number << 3 | 2) + varint(len(data)) + data


def unigram_model(strip: int) -> bytes:
    import struct

    own = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256))]
    own += [("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.1, 1), ("▁a", -2.2, 1), ("▁ab", -3.0, 1), ("ba", -3.3, 1)]
    piece = lambda t, s, k: field(1, t.encode()) + b"\x15" + struct.pack("<f", s) + field(3, k)
    trainer = field(3, 1) + field(35, 1)
    normal = field(1, b"identity") + field(3, 1) + field(4, strip) + field(5, 1)
    return b"".join(field(1, piece(*p)) for p in own) + field(2, trainer) + field(3, normal)


@pytest.mark.parametrize("strip", [0, 1])
def test_unigram_models_agree_with_the_library(tmp_path, strip):
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(unigram_model(strip))
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", "ab", "abab ba  aab", "  b a ", "<s>ab", "a <0x41>b <0x3C>", "é", "aaaa bbbb abba", "a\nb"]
    ids, offsets, same = pieces.Codec(path).encode_parts(pa.array(texts), True)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode(t) for t in texts]
    assert same.all()


def test_model_file(model):
    own = read_model(model)
    assert len(own.pieces) == 32_000 and own.byte_fallback and own.splits_at_spaces()
    with pytest.raises(ValueError):
        parse_model(b"\x0b\x00")
    with pytest.raises(ValueError, match="vocabulary"):
        pieces.Codec(model).decode([[40_000]])
