"""Stages of the pipeline on odd rows, and what the toxicity query returns."""

import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from airmart.llm import jaccard, passages, pieces, queries, warc

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k}" for k in range(60))
NEAR = LONG.replace("w30", "x")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)


def test_no_text_is_lost_with_its_class(spark):
    rows = [(1, LONG), (1, None), (2, LONG), (3, NEAR), (3, "something quite unlike it in every single word"), (4, ""), (4, ""), (5, " \n"), (None, LONG), (None, "only without an id but long enough"), (None, "only without an id but long enough")]
    got = rows_of(corpus_pipeline.one_of_each_class(spark, frame(spark, rows), ""), "doc_id", "text")
    want = [(1, LONG), (1, None), (3, "something quite unlike it in every single word"), (4, ""), (4, ""), (5, " \n"), (None, "only without an id but long enough")]
    assert got == sorted(want, key=str)


def test_names_that_clash_and_no_rows(spark):
    df = frame(spark, [(2, LONG), (1, NEAR)]).withColumns({c: F.lit(7) for c in ("_place", "place", "KEY", "_key", "id", "none")})
    out = corpus_pipeline.one_of_each_class(spark, df, "")
    assert out.columns == df.columns and [(r.doc_id, r.place, r["_place"]) for r in out.collect()] == [(1, 7, 7)]
    assert corpus_pipeline.one_of_each_class(spark, df.limit(0), "").count() == 0
    assert jaccard.unused(["Key", "_key"], "key", "key") == ["__key", "___key"]


@pytest.mark.parametrize("stage", [0, 2, 3, 4])
def test_stages_take_odd_rows(spark, sf001, stage):
    rows = [(1, None), (2, ""), (2, "a b"), (2, "a b"), (None, "mail me at a.b@example.org"), (3, "word " * 30_000)]
    df = frame(spark, rows).drop("n_chars").withColumn("key", F.lit("k")).withColumn("ids", F.lit(1))
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, df, sf001)
    assert out.count() == len(rows)
    assert run(spark, df.limit(0), sf001).count() == 0
    if name != "encoding":
        assert out.columns == df.columns
        same = rows_of(out, "doc_id", "text") == rows_of(df, "doc_id", "text")
        assert same == (name != "personal data")
    else:
        assert [(r.n_tokens, r.ids, r.round_trip) for r in out.where("doc_id = 1").collect()] == [(0, None, None)]


def test_toxicity_query_keeps_its_contract(spark, sf01):
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf01, "labels").collect()}
    rows = queries.op3_toxicity(spark, sf01).collect()
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            right.append(r.predicted == labels[r.doc_id])
    assert len(rows) == 1000 and len(right) > 10 and sum(right) >= 0.9 * len(right)


def test_rows_of_one_labelled_id_reach_the_driver_once(spark):
    from airmart.llm import toxicity

    docs = spark.createDataFrame([(1, f"text {k}") for k in range(300)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.labelled_sample(docs, labels) == (["text 0", "other"], [1, 0])


def test_parity_is_checked_on_every_segment(model):
    import pyarrow as pa

    class Other:  # a library that knows one word differently
        def __init__(self, own):
            self.own = own

        def encode(self, texts, num_threads):
            return [x if t != "odd" else [1] for t, x in zip(texts, self.own.encode(texts, num_threads=1))]

        def decode(self, ids, num_threads):
            return self.own.decode(ids, num_threads=1)

    own = pieces.Codec(model)
    own.__dict__["library"] = Other(own.library)
    own.encode(pa.array([None] * 8 + ["", "plain words"]))
    with pytest.raises(ValueError, match="differs"):
        own.encode(pa.array([None] * 20 + ["plain words and an odd one"]))


def test_bundles_are_read_by_as_many_tasks(spark, tmp_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("x"), F.sha2(F.col("id").cast("string"), 512)).alias("html"))
    index = warc.write_archive(pages, f"{tmp_path}/w", frame_bytes=1000, bundle_bytes=2000)
    bundles = index.select("bundle").distinct().count()
    assert bundles > 8 and warc.read_archive(index).rdd.getNumPartitions() == min(bundles, 32)
    assert warc.read_archive(index).count() == 400


def test_chat_pieces_have_an_order(spark, sf001):
    got = queries.op6_chat(spark, sf001)
    assert {"part", "seq"} <= set(got.columns) and got.select("seq").distinct().count() == got.count()


def test_passages_of_repeated_ids_are_those_of_the_smallest_text(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(80)) for x in "ab")
    rows = [(i, t) for i in range(20) for t in (a, b)] + [(100, a), (200, b)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {(r.doc_id, r.source_id) for r in got.collect()} == {(i, 0) for i in [*range(1, 20), 100]}


def test_a_place_of_any_text_fits_its_key():
    """Arrow holds texts below 2**31 bytes, so fewer places than that."""
    assert int(passages._PLACE) >= 1 << 31
