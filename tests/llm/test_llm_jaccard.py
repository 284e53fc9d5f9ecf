"""The n-gram join against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from airmart.llm import jaccard, queries
from airmart.llm.components import components


def brute(rows, width=5, percent=80):
    sets = {}
    for i, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
        sets[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    lists = defaultdict(list)
    for i, own in sets.items():
        for g in own:
            lists[g].append(i)
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, own in sets.items():
        for j, n in Counter(j for g in own for j in lists[g] if j > i).items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(own), top(i)) for i, own in sets.items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_all_documents_agree_with_brute_force(spark, sf01):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf01, "documents").collect()]
    assert found(queries.op2_jaccard(spark, sf01)) == brute(rows)


@pytest.mark.parametrize("block_sets", [2048, 3])
def test_chains_borders_and_short_texts(spark, block_sets):
    rng = random.Random(5)
    rows = [(1, "a b c"), (2, "A  b\tc"), (3, "a b"), (4, ""), (5, None), (6, " \n"), (7, "x"), (8, "x")]
    for family in range(6):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for step in range(12):
            own = list(words)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(60)] = f"w{rng.randrange(10**6)}"
            if step % 3 == 0:
                words = own
            rows.append((100 * family + step + 20, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", jaccard.F.lit(1)).repartition(5)
    assert found(jaccard.similar_classes(df, block_sets=block_sets)) == brute(rows)


@pytest.mark.parametrize("block_sets", [2048, 3])
def test_every_link_counts(spark, block_sets):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(80)]
    texts = [" ".join(words[:k] + [f"x{rng.randrange(10**6)}"] + words[k + 1 :]) for k in range(0, 80, 8)]
    rows = list(enumerate(texts + texts[:2] + [None, "", "a b", "a b"]))
    own = {i: {tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} if t else set() for i, t in rows}
    want = {i: sum(i != j and len(x) > 0 and 100 * len(x & y) >= 80 * len(x | y) for j, y in own.items()) for i, x in own.items()}
    got = jaccard.similar_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), block_sets=block_sets).collect()
    assert {r.doc_id: r.n_links for r in got} == want and sum(want.values()) > 2 * len(rows)


def pairs(links):
    return [(q, int(x)) for q, found in links for x in found]


def test_every_pair_is_found_once():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 10**6, 60)
    sets = [np.unique(np.where(rng.random(60) < 0.06, rng.integers(0, 10**6, 60), base)).astype(np.uint64) for _ in range(15)]
    sizes = np.array([len(s) for s in sets])
    want = {(a, b) for a in range(15) for b in range(a + 1, 15) if 100 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (sizes[a] + sizes[b] - n)}
    assert sorted(pairs(jaccard.block_links(sets, sizes, 80))) == sorted(want) and len(want) > 15
    first = np.arange(15) < 6
    assert sorted(pairs(jaccard.block_links(sets, sizes, 80, first))) == sorted(p for p in want if p[0] < 6 <= p[1])


def test_heap_merge_counts_values():
    rng = np.random.default_rng(8)
    for n in (1, 2, 16, 17, 300):
        lists = [np.unique(rng.integers(0, 50, rng.integers(1, 9))) for _ in range(n)]
        values, counts = jaccard.heap_merged(lists)
        want = Counter(x for own in lists for x in own.tolist())
        assert dict(zip(values.tolist(), counts.tolist())) == want and values.tolist() == sorted(want)


def test_counts_and_connections_of_a_block():
    rng = random.Random(9)
    for _ in range(40):
        n, weights = 12, np.array([rng.randrange(1, 4) for _ in range(12)])
        links = [(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.12]
        rng.shuffle(links)
        count, parent = jaccard.counted_links(((a, np.array([b])) for a, b in links), weights)
        assert count.tolist() == [sum(weights[b if a == k else a] for a, b in links if k in (a, b)) for k in range(n)]
        up = list(range(n))
        for a, b in links:
            x, y = up[a], up[b]
            up = [min(x, y) if u in (x, y) else u for u in up]
        top = lambda k: k if parent[k] == k else top(parent[k])
        assert [top(k) for k in range(n)] == up


def test_a_large_group_leaves_one_row_a_set(spark):
    rng = random.Random(10)
    words = [f"w{k}" for k in range(120)]
    texts = [" ".join([*words[:k], f"x{i}", *words[k + 1 :]]) for i in range(300) for k in (rng.randrange(120),)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard.similar_classes(docs, block_sets=64).collect()
    assert {r.component_id for r in rows} == {0} and sum(r.n_links for r in rows) > 300 * 250


def test_null_ids_and_repeated_rows(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (None, "alone but long enough to count")], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_classes(df).collect())
    assert got == Counter({(None, 3, 4): 1, (4, 3, 4): 2, (None, 2, None): 1})


def test_empty_table(spark):
    assert jaccard.similar_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_block_search_finds_what_pairs_find():
    rng = np.random.default_rng(1)
    for _ in range(20):
        base = rng.integers(0, 10**6, 50)
        sets = [np.unique(np.where(rng.random(50) < 0.08, rng.integers(0, 10**6, 50), base)).astype(np.uint64) for _ in range(12)]
        label = list(range(12))
        for a, b in pairs(jaccard.block_links(sets, np.array([len(s) for s in sets]), 80)):
            shared = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared)
            label = [label[a] if x == label[b] else x for x in label]
        for a in range(12):
            for b in range(a):
                shared = len(np.intersect1d(sets[a], sets[b]))
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    assert label[a] == label[b]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(500, 400), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 400: 400, 500: 400}
