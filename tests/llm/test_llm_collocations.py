"""Collocations against SQL and brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airmart.llm import collocations, queries
from workload.compare import connect, differences


def pieces(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [[w for w in re.split("[\x20\x09]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def brute(rows, longest=5, at_least=100, first=2000):
    """Contract rows for (lang, text)."""
    out, by = [], {}
    for lang, text in rows:
        by.setdefault("und" if lang is None else lang, []).extend(pieces(text))
    for lang, own in by.items():
        n, count = sum(map(len, own)), Counter()
        for p in own:
            count.update(tuple(p[i : i + k]) for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        count = {g: c for g, c in count.items() if c >= at_least}
        many = {g: c for g, c in count.items() if len(g) > 1}
        inside = Counter()
        for g, c in many.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i : i + k]] = max(inside[g[i : i + k]], c)
        scored = []
        for g, a in many.items():
            score, _, left, right = min((1000 * a * n // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
            if not inside[g] >= a:
                scored.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_agrees_with_sql(spark, sf01):
    assert differences(queries.op11_collocations(spark, sf01), connect(sf01), queries.all_oracles()["op11_collocations"]) == []


def test_all_documents(spark, sf01):
    rows = [(r.lang, r.text) for r in queries.table(spark, sf01, "documents").collect()]
    got = found(queries.op11_collocations(spark, sf01))
    assert got == brute(rows) and len(got) > 50


@pytest.mark.parametrize("batch_bytes", [8 << 20, 500])
def test_odd_texts_and_small_batches(spark, odd_texts, batch_bytes):
    rng = random.Random(3)
    words = ["a", "b", "c", "of", "The", "É", "\x00", "x-y", "a b", "日本"]
    rows = [(rng.choice(["en", "en", "en", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "?", "\x0b"]) for _ in range(rng.randrange(80)))) for _ in range(300)]
    rows += [("en", t) for t in odd_texts] + [("en", None), (None, None), ("de", "word " * 40_000)] + [("fr", "same text here, again and again.")] * 40
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("n", F.lit(1)).withColumn("phrase", F.lit("x")).repartition(4)
    got = found(collocations.collocations(df, at_least=7, first=50, batch_bytes=batch_bytes))
    assert got == brute(rows, at_least=7, first=50) and {r[0] for r in got} == {"en", "und", "", "de", "fr"}


def test_colliding_fingerprints_change_nothing(spark, monkeypatch):
    """Few different fingerprints: everything collides, and counts are right all the same."""
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice("abcdefgh") for _ in range(60))) for _ in range(20)]
    words, numbers = collocations.coded(pa.array([t for _, t in rows]))
    batch = collocations.Batch("en", *collocations.Batch.packed(words, numbers))
    monkeypatch.setattr(collocations.Batch, "fingerprints", lambda self, n, at: self.numbers[at].astype(np.uint64) % np.uint64(2))
    got = Counter()
    for at, count in batch.counted(2, batch.places(2)):
        got[batch.phrase(2, at)] += count
    want = Counter(" ".join(p[i : i + 2]) for _, t in rows for p in pieces(t) for i in range(len(p) - 1))
    assert got == want


def test_products_beyond_64_bits(spark):
    big = 3 * 10**12
    found = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, n_words int, a long")
    counts = spark.createDataFrame([("en", "a", 1, big + 1), ("en", "b", 1, big + 2)], "lang string, phrase string, n_words int, n long")
    words = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    assert collocations.scored(found, counts, words).first().score == 1000 * big * 10**13 // ((big + 1) * (big + 2))


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", ""), (None, None)], "lang string, text string")).count() == 0
