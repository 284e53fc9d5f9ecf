"""Merkle manifests against hashlib."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from airmart.llm import merkle, queries, sha_state
from workload.compare import connect, differences


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest("".join(found[-1][k : k + 3])) for k in range(0, len(found[-1]), 3)])
    return found


def climb(tree, at, node):
    """Siblings of a node up to the top, and what a replacement of it leads to."""
    near = []
    for own in tree[:-1]:
        run = list(own[at // 3 * 3 : at // 3 * 3 + 3])
        near += run[: at % 3] + run[at % 3 + 1 :]
        run[at % 3] = node
        node, at = digest("".join(run)), at // 3
    return near, node


def brute(rows):
    """Rows of the contract for (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0], leaf(*r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([d for _, d, _ in sorted(by[s], key=lambda x: ((x[0] is not None, x[0] or 0), x[1]))]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for at, s in enumerate(sources):
        for k, (i, own, r) in enumerate(sorted(by[s], key=lambda x: ((x[0] is not None, x[0] or 0), x[1]))):
            bad = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and r[4] is not None
            new = leaf(*r[:4], r[4].replace("\n", "")) if bad else own
            near, sub = climb(trees[s], k, new)
            more, folded = climb(top, at, sub)
            out.append((i, own, trees[s][-1][0], root, digest("".join(near + more)), folded, folded == root))
    return sorted(out, key=str)


def found(spark, rows, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("tree", F.lit(1)).repartition(3).write.parquet(path)
    return sorted((tuple(r) for r in queries.op13_merkle(spark, str(tmp_path)).collect()), key=str)


def test_states_agree_with_hashlib():
    rng = np.random.default_rng(1)
    many = rng.integers(0, 256, (3, 50, 32), np.uint8)
    for n in (1, 2, 3):
        state = sha_state.start(50)
        for k in range(n):
            state = sha_state.absorb(state, sha_state.block(many[k]))
        got = sha_state.finish(state, np.full(50, n))
        assert [g.tobytes().hex() for g in got] == [digest("".join(many[k][i].tobytes().hex() for k in range(n))) for i in range(50)]


def test_all_documents(spark, sf01):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in queries.table(spark, sf01, "documents").collect()]
    assert sorted((tuple(r) for r in queries.op13_merkle(spark, sf01).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("name", ["op13_merkle"])
def test_agrees_with_sql(spark, sf001, name):
    assert differences(queries.all_queries()[name](spark, sf001), connect(sf001), queries.all_oracles()[name]) == []


@pytest.mark.parametrize("height", [1, 2])
def test_several_rounds_and_odd_rows(spark, tmp_path, monkeypatch, height):
    whole = merkle.build
    monkeypatch.setattr(merkle, "build", lambda leaves: whole(leaves, height=height))
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", "é", "e", "z\U0001f600", "￿"]), "en", i, f"line {i}\nmore\n") for i in range(120)]
    rows += [(k, f"own{k:03d}", None, None, "x\n" * k) for k in range(30)]
    rows += [(None, "hot", "en", 1, "a\nb"), (7, None, None, None, None), (8, None, "de", 2, ""), (9, "", "de", 2, "\n" * 70_000), (9, "", "de", 2, "other")]
    rows += [(10, "twice", "en", 3, "a\nb")] * 3 + [(0, "alone", "en", 3, "a")]
    assert found(spark, rows, tmp_path) == brute(rows)


def test_one_row_and_no_row(spark, tmp_path):
    (tmp_path / "one").mkdir()
    rows = [(5, None, "en", 3, "a\n")]
    assert found(spark, rows, tmp_path / "one") == brute(rows)
    assert found(spark, [], tmp_path) == []


def test_a_kept_manifest_reads_back(spark, tmp_path):
    rows = [(f"s{k % 3}", k, digest(str(k)), digest(f"new{k}")) for k in range(50)]
    leaves = spark.createDataFrame(rows, "series string, id long, digest string, replacement string")
    merkle.build(leaves, f"{tmp_path}/m")
    kept = merkle.read_manifest(spark, f"{tmp_path}/m")
    same = merkle.fold(kept, with_proof=True).collect()
    assert all(r.verified and r.folded_root == kept.root() and digest(r.proof) == r.proof_sha256 for r in same) and len(same) == 50
    assert {r.id for r in merkle.fold(kept, leaves.where("id < 5")).where("not verified").collect()} == set(range(5))
    assert kept.subroots().count() == 3
