"""WARC bundles, nearest neighbours, chats and the pipeline."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from airmart.llm import chat, neighbours, queries, warc


def expected_records(rows):
    """(page_id, bytes, digest, type, refers_to) for rows (page_id, html) with ids."""
    payloads = [(i, (h or "").encode()) for i, h in rows]
    head = {}
    for i, p in payloads:
        head[p] = min(i, head.get(p, i))
    digest = lambda p: base64.b32encode(hashlib.sha1(p).digest()).decode()
    return sorted((i, len(p), digest(p), "response" if head[p] == i else "revisit", None if head[p] == i else head[p]) for i, p in payloads)


def test_every_page_reads_back(spark, sf01):
    rows = [(r.page_id, r.html) for r in queries.table(spark, sf01, "pages").collect()]
    got = sorted(tuple(r) for r in queries.op8_warc(spark, sf01).collect())
    assert got == expected_records(rows)


def test_bundles_are_seekable(spark, tmp_path):
    rows = [(i, f"http://x/{i}" if i % 3 else None, ("<p>é" * (i % 7)) if i % 5 else None) for i in range(60)] + [(100, "http://a b\r\nX: y", "z" * 300_000), (5, "http://x/5", "<p>é" * 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("bundle", F.lit(1)).repartition(4)
    index = warc.write_archive(df, f"file://{tmp_path}/w", frame_bytes=2000, bundle_bytes=3000)
    got = sorted(tuple(r) for r in warc.read_archive(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == expected_records([(i, h) for i, _, h in rows])
    one = warc.read_records(index.where("page_id = 100")).first()
    assert one.payload == b"z" * 300_000 and one.url == "http://a%20b%0D%0AX:%20y" and one.record_type == "response"
    assert index.select("bundle").distinct().count() > 1
    for r in index.select("bundle").distinct().collect():
        with warc.open_uri(r.bundle) as file:
            table = warc.seek_table(file)
            file.seek(0)
            data = file.read()
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert sum(n for *_, n in table) == len(plain) and plain.startswith(b"WARC/1.1\r\n")
        for at, size, n in table:
            assert len(zstandard.ZstdDecompressor().decompress(data[at : at + size])) == n
    assert fs.LocalFileSystem().get_file_info(f"{tmp_path}/w").type == fs.FileType.Directory


def test_archive_of_odd_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, None, "a"), (3, None, "a"), (None, "u", "alone"), (4, "u", None), (2, "u", "")], "page_id long, url string, html string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.read_archive(warc.write_archive(df, f"{tmp_path}/a")).collect()}
    assert got == {(None, "revisit", 3), (3, "response", None), (None, "response", None), (4, "revisit", 2), (2, "response", None)}
    few = warc.write_archive(df, f"{tmp_path}/b", min_revisit_bytes=2)
    assert {r.record_type for r in warc.read_archive(few).collect()} == {"response"}
    assert warc.read_archive(warc.write_archive(df.limit(0), f"{tmp_path}/c")).count() == 0


def brute(rows, every, k=10):
    items = [(i, np.array(v)) for i, v in rows]
    out = {}
    for q, x in items:
        if q % every == 0:
            near = sorted({i: float(np.sqrt(((y - x) ** 2).sum())) for i, y in items if i != q}.items(), key=lambda p: (p[1], p[0]))
            out[q] = near[:k]
    return out


def test_recall_on_all_vectors(spark, sf01):
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, sf01, "embeddings").collect()]
    rows = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    want = brute(rows, 100)
    got = {}
    for r in queries.op9_neighbours(spark, sf01).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    exact = dict(rows)
    hits = 0
    for q, near in want.items():
        hits += len({i for i, _ in near} & {i for i, _ in got[q]})
        for i, score in got[q]:
            assert score == pytest.approx(np.sqrt(((np.array(exact[i]) - np.array(exact[q])) ** 2).sum()), abs=1e-12)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_small_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(30)] + [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100, 130)]
    odd = [(200, None), (300, [0.0] * 4), (400, [1.0, None, 1.0, 1.0]), (500, [float("nan")] * 4), (600, [float("inf")] * 4), (700, [1.0]), (None, [1.0] * 4), (10, rows[10][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("query_id", F.lit(2)).repartition(3)
    want = brute(rows, 10)
    for size in ({}, {"block_rows": 7, "block_queries": 2}):
        got = {}
        for r in neighbours.search(df, F.col("vec_id") % 10 == 0, n_pivots=4, probed=4, posted=4, **size).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert {q: [i for _, i, _ in near] for q, near in got.items()} == {q: [i for i, _ in near] for q, near in want.items()}
        assert all([p for p, *_ in near] == list(range(1, len(near) + 1)) for near in got.values())
    assert neighbours.search(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert neighbours.search(df.where("vec_id = 10"), F.col("vec_id") % 10 == 0).count() == 0


def cheapest(roles):
    best = chat.FAR

    def go(i, state, cost):
        nonlocal best
        if cost >= best:
            return
        if i == len(roles):
            best = min(best, cost + int(chat.END_COST[state]))
            return
        if state:
            go(i + 1, state, cost + chat.COSTS["merge" if state == roles[i] else "merge other"])
        for between in (0, *chat.NEXT[state]):
            for made in chat.NEXT[between or state]:
                go(i + 1, made, cost + chat.relabel_cost(roles[i], made) + chat.COSTS["insert"] * (between > 0))

    go(0, chat.NONE, 0)
    return best


def test_repairs_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(150):
        roles = [rng.randint(1, 4) for _ in range(rng.randint(1, 6))]
        ways = chat.repair(np.array(roles))
        assert sum(w[0] for w in ways) + int(chat.END_COST[ways[-1][2]]) == cheapest(roles)


@pytest.mark.parametrize("parts", [1, 5])
def test_long_conversations_are_repaired_as_one(spark, parts):
    rng = random.Random(1)
    rows = [(1, i, rng.choice(["user", "assistant", "System ", "tool", None, "human"]), f"t{i};") for i in range(900)]
    rows += [(2, 0, "user", "x"), (None, None, None, None), (3, 1, "assistant", "y"), (3, 1, "assistant", "y"), (4, 0, "user", "q"), (4, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1)).withColumn("cost", F.lit(2))
    got = chat.format_chats(df, parts=parts).orderBy("part", "seq").collect()
    whole = {c: "".join(r.piece for r in got if r.conv_id == c) for c in (1, 2, 3, 4, None)}
    assert whole[4] == "<|user|>\nq\n<|end|>\n<|assistant|>\na\n<|end|>\n"
    assert whole[2] == "<|user|>\nx\n<|end|>\n<|assistant|>\n\n<|end|>\n".replace("\n\n<|end", "\n<|end")
    assert sorted(r.conv_id or 0 for r in got) == sorted(c or 0 for c, *_ in rows)
    for text in whole.values():
        made = [r for r in re.findall(r"<\|(\w+)\|>", text) if r != "end"]
        legal = made[1:] if made[0] == "system" else made
        assert legal == ["user", "assistant"] * (len(legal) // 2) and text.count("<|end|>") == len(made)
    assert re.findall(r"t\d+;", whole[1]) == [f"t{i};" for i in range(900)]
    codes = [{"user": 2, "human": 2, "assistant": 3, "System ": 1}.get(r, 4) for _, _, r, _ in rows[:900]]
    assert sum(r.cost for r in got if r.conv_id == 1) == sum(w[0] for w in chat.repair(np.array(codes)))
    assert chat.format_chats(df.limit(0)).count() == 0


def test_pipeline_keeps_what_each_stage_should(spark, sf001):
    import corpus_pipeline

    docs = queries.table(spark, sf001, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "decontamination", "personal data", "encoding"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = spark.createDataFrame(stage(spark, kept, sf001).collect(), docs.schema)
        after = {r.doc_id: r.text for r in kept.collect()}
        assert kept.columns == docs.columns and set(after) <= set(before) and after
        if name == "near duplicates":
            from airmart.llm import jaccard

            frame = spark.createDataFrame(list(before.items()), "doc_id long, text string")
            assert set(after) == {r.component_id for r in jaccard.similar_classes(frame).collect()}
        elif name == "personal data":
            assert set(after) == set(before)
    ids = {r.doc_id for r in kept.collect()}
    last = corpus_pipeline.STAGES[4][1](spark, kept, sf001).collect()
    assert {r.doc_id for r in last} == ids and all(r.round_trip for r in last)
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf001).collect()} == ids
