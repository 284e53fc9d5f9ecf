"""Passages, decontamination, toxicity and pseudonyms."""

import re
from collections import defaultdict
from datetime import date

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airmart.llm import decontaminate, passages, pseudonyms, queries, toxicity


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]


def test_compact_windows_agree_with_brute_force():
    rng = np.random.default_rng(0)
    for length in (1, 6, 11):
        hashes, valid = rng.integers(0, 40, 120).astype(np.uint64) << np.uint64(40), rng.random(120) > 0.03
        key = (passages.mixed(hashes + np.uint64(3)) | np.uint64(1 << 63)) & ~passages._PLACE | np.arange(120, dtype=np.uint64)
        key[~valid] = 0
        want = []
        for c in np.flatnonzero(valid):
            left = right = c
            while left > 0 and key[left - 1] > key[c]:
                left -= 1
            while right < 119 and key[right + 1] > key[c]:
                right += 1
            if right - left + 1 >= length:
                want.append((left, c, right))
        assert want == list(zip(*(x.tolist() for x in passages.compact_windows(hashes, valid, 3, length))))


def test_every_exact_repeat_is_found(spark, sf01):
    seen = defaultdict(set)
    texts = {r.doc_id: words_of(r.text) for r in queries.table(spark, sf01, "documents").collect()}
    for i, words in texts.items():
        for k in range(len(words) - 49):
            seen[tuple(words[k : k + 50])].add(i)
    need = {i for ids in seen.values() if len(ids) > 1 for i in ids - {min(ids)}}
    found = queries.op4_passages(spark, sf01).collect()
    assert need <= {r.doc_id for r in found}
    for r in found:
        a = texts[r.doc_id][r.start_word : r.start_word + r.n_words]
        b = texts[r.source_id][r.source_word : r.source_word + r.source_words]
        x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
        assert len(x & y) / len(x | y) == pytest.approx(r.similarity) and r.similarity >= 0.8 and r.n_words >= 50


def test_passages_of_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 1), (2, "z " + text, 2), (3, None, 3), (4, "", 4), (None, text, 5), (6, "short", 6), (7, text + " " + " ".join("qrs") + " " + text, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key long")
    got = {(r.doc_id, r.source_id) for r in passages.repeated_passages(df).collect()}
    assert {(2, 1), (7, 1)} <= got and all(d in (2, 7) for d, _ in got)
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_a_passage_is_found_beside_common_phrases(spark):
    """Two documents share a passage; each stretch around its smallest shingles also occurs in earlier documents."""
    rng = np.random.default_rng(8)

    def word():
        return f"v{rng.integers(10**9)}"

    passage = [word() for _ in range(50)]
    text = " ".join(passage)
    own = passages.runs(next(passages.blocks(pa.array([text])))[1].text(0), 5)
    rows = []
    for k in range(passages.HASHES):
        c = int(np.argmin((passages.mixed(own + np.uint64(k + 1)) | np.uint64(1 << 63)) & ~passages._PLACE))
        for _ in range(12):
            while True:  # a stranger in which the phrase of the smallest shingle has the smallest hash as well
                words = [word() for _ in range(100)]
                words[48:53] = passage[c : c + 5]
                other = passages.runs(next(passages.blocks(pa.array([" ".join(words)])))[1].text(0), 5)
                low = (passages.mixed(other + np.uint64(k + 1)) | np.uint64(1 << 63)) & ~passages._PLACE
                if any(int(np.argmin(low[i : i + 46])) + i == 48 for i in range(3, 49)):
                    break
            rows.append((len(rows), " ".join(words)))
    rows += [(500, " ".join([word() for _ in range(9)] + passage)), (501, " ".join(passage + [word() for _ in range(9)]))]
    found = {(r.doc_id, r.source_id) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(501, 500)}


def test_phrase_of_a_passage_elsewhere_in_the_stretch():
    rng = np.random.default_rng(9)
    passage = rng.integers(1, 2**32, 46).astype(np.uint32)

    def fill(n):
        return rng.integers(1, 2**32, n).astype(np.uint32)

    b = np.concatenate([fill(5), passage[20:21], fill(30), passage, fill(20), passage[3:4]])
    assert passages.matching(passage, b, 46, 80) == [(0, 45, 36, 81, 1.0)]
    for shift in (36, 0, 70):
        assert passages.matching(passage, b, 46, 80, shift) == [(0, 45, 36, 81, 1.0)]
    a = np.concatenate([fill(10), passage, fill(10)])
    assert all(x[4] >= 0.8 for x in passages.matching(a, b, 46, 80, 26)) and passages.matching(a, b, 46, 80, 26)
    for _ in range(20):
        values, counted = rng.integers(0, 12, 60), rng.random(60) < 0.5
        counted = counted[values]
        assert passages.distinct_in_windows(values, counted, 9).tolist() == [len(set(values[i : i + 9][counted[i : i + 9]])) for i in range(52)]


def shingle_set(words):
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_all_links_of_large_groups_are_found(spark):
    """Texts of one window each: all pairs of different contents, and one row a copy."""
    rng = np.random.default_rng(11)

    def words(n):
        return [f"v{x}" for x in rng.integers(10**9, size=n)]

    texts = []
    for size, base in ((9, words(50)), (30, words(50)), (60, words(50)), (30, words(10) * 5)):
        for _ in range(size):
            text = list(base)
            for at in rng.integers(0, 50, rng.integers(0, 3)):
                text[at] = words(1)[0]
            texts.append(text)
    rows = {i: texts[k] for i, k in enumerate(rng.permutation(len(texts)))}
    number = defaultdict(int)
    sets = {i: shingle_set(t) for i, t in rows.items()}
    for t in rows.values():
        for k in range(46):
            number[tuple(t[k : k + 5])] += 1

    def linked(i, j):
        return 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])

    first = {}
    key = {i: (frozenset(x for x in s if number[x] > 1), len(s)) for i, s in sets.items()}
    for i in sorted(rows):
        first.setdefault(key[i], i)
    own = {i: first[key[i]] if linked(i, first[key[i]]) else i for i in rows}
    want = {(i, own[i]) for i in rows if own[i] != i}
    want |= {(i, j) for i in rows for j in range(i) if own[i] == i and own[j] == j and linked(i, j)}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows.items()], "doc_id long, text string").repartition(4)
    found = passages.repeated_passages(df).collect()
    assert want <= {(r.doc_id, r.source_id) for r in found} and len(want) > 70
    for r in found:
        a = shingle_set(rows[r.doc_id][r.start_word : r.start_word + r.n_words])
        b = shingle_set(rows[r.source_id][r.source_word : r.source_word + r.source_words])
        assert len(a & b) / len(a | b) == pytest.approx(r.similarity) and r.similarity >= 0.8


def test_passages_give_classes_and_not_all_pairs(spark, tmp_path):
    """Families of near copies of one window each: classes equal brute force, every linked document has a row, and rows grow with documents."""
    rng = np.random.default_rng(13)

    def words(n):
        return [f"u{x}" for x in rng.integers(10**9, size=n)]

    texts = [words(50) for _ in range(20)] + [[]]
    for size, base in ((120, words(50)), (60, words(50)), (40, words(10) * 5)):
        for _ in range(size):
            text = list(base)
            for at in rng.integers(0, 50, rng.integers(0, 3)):
                text[at] = words(1)[0]
            texts.append(text)
    rows = {i: texts[k] for i, k in enumerate(rng.permutation(len(texts)))}
    sets = {i: shingle_set(t) for i, t in rows.items()}
    near = {i: {j for j in rows if j != i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) > 0} for i in rows}
    want = {}
    for i in sorted(rows):  # the smallest document first
        todo = [i] if near[i] and i not in want else []
        while todo:
            j = todo.pop()
            if j not in want:
                want[j] = i
                todo += near[j]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows.items()], "doc_id long, text string")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op4_passages(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.class_id for r in found} == want and len(want) > 100
    assert all(r.source_id in near[r.doc_id] and want[r.source_id] == r.class_id for r in found)
    assert len(found) < 4 * len(want) < sum(map(len, near.values())) / 2


def test_every_linked_window_is_reported():
    rng = np.random.default_rng(12)

    def share(x, y):
        return len(np.intersect1d(x, y)) / len(np.union1d(x, y))

    hits = 0
    for k in range(60):
        a, b = (rng.integers(1, (4, 12)[k % 2], 40).astype(np.uint32) for _ in "ab")
        b[5:17] = a[20:32]
        for found, earlier in ((passages.matching(a, b, 8, 80), b), (passages.matching_within(np.append(b, a), 8, 80), None)):
            text = a if earlier is not None else np.append(b, a)
            for first, last, low, high, similarity in found:
                partner = (b if earlier is not None else text)[low : high + 1]
                assert last - first >= 7 and similarity == pytest.approx(share(text[first : last + 1], partner)) and similarity >= 0.8
                assert earlier is not None or high < first
            for i in range(len(text) - 7):
                before = range(33) if earlier is not None else range(i - 7)
                if any(share(text[i : i + 8], (b if earlier is not None else text)[j : j + 8]) >= 0.8 for j in before):
                    hits += 1
                    assert any(first <= i + 7 and i <= last for first, last, *_ in found)
    assert hits > 500


def longest_first(item, doc, least):
    """Greedy tiling by trying all places."""
    used_i, used_d, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and i + n not in used_i and j + n not in used_d:
                    n += 1
                best = max(best, (n, -i, -j))
        if best[0] < least:
            return covered
        used_i |= set(range(-best[1], -best[1] + best[0]))
        used_d |= set(range(-best[2], -best[2] + best[0]))
        covered += best[0]


def test_tilings_agree_with_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(30):
        item, doc = (rng.integers(1, 4, n).astype(np.uint64) for n in (14, 25))
        found = decontaminate.tiles(item, doc, 3)
        assert sum(n for *_, n in found) == longest_first(item.tolist(), doc.tolist(), 3)
        for i, j, n in found:
            assert (item[i : i + n] == doc[j : j + n]).all()


def test_reordered_passages_are_caught(spark):
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[15:] + ["y"] + words[:15])), (3, " ".join(words[:12])), (4, None), (5, ""), (None, " ".join(words)), (1, "W3 other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(9))
    items = spark.createDataFrame([(7, " ".join(words)), (8, None), (9, "w3 other"), (10, "")], "item_id long, text string")
    for filter_bits in (24, 7):  # the smaller lets through what nothing has in common
        found = decontaminate.tilings(docs, items, filter_bits=filter_bits).collect()
        assert sorted(((r.doc_id or 0, r.item_id, round(r.coverage, 2), len(r.tiles)) for r in found)) == [(0, 7, 1.0, 1), (1, 7, 1.0, 1), (1, 9, 1.0, 1), (2, 7, 1.0, 2)]
        kept = decontaminate.without_covered(docs, items, filter_bits=filter_bits)
        assert kept.columns == docs.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(3, rows[2][1]), (4, None), (5, "")])
    assert decontaminate.tilings(docs.limit(0), items).count() == 0 and decontaminate.tilings(docs, items.limit(0)).count() == 0


def test_items_that_repeat_themselves(spark):
    docs = spark.createDataFrame([(1, "la " * 40), (2, "x la la la la y"), (3, "la la la")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "la " * 20), (2, "la la la la"), (3, "la la")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.n_covered for r in decontaminate.tilings(docs, items).collect()}
    assert found == {(1, 1): 20, (1, 2): 4, (1, 3): 2, (2, 2): 4, (2, 3): 2, (3, 3): 2}
    assert decontaminate.tilings(docs, items).where("item_id = 1").first().tiles[0].n_words == 20


def test_decontamination_agrees_with_brute_force(spark, sf001):
    docs = {r.doc_id: words_of(r.text) for r in queries.table(spark, sf001, "documents").collect()}
    items = {r.item_id: words_of(r.text) for r in queries.table(spark, sf001, "benchmark").collect()}
    want = set()
    for d, own in docs.items():
        grams = {tuple(own[k : k + 4]) for k in range(len(own) - 3)}
        for i, words in items.items():
            if any(tuple(words[k : k + 4]) in grams for k in range(len(words) - 3)) and longest_first(words, own, 4) >= 0.6 * len(words):
                want.add((d, i))
    assert {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, sf001).collect()} == want


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(4)
    net = toxicity.Network.start(1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, first, size = rng.normal(size=(40, toxicity.INPUTS)), np.array([0, 5, 20]), np.array([5, 9, 3])
    logit, memory = net.forward(x, first, size, True)
    slope = np.array([1.0, -2.0, 0.5])
    grads = net.gradients(slope, memory)
    for name, value in net.weights.items():
        at = tuple(rng.integers(0, n) for n in value.shape)
        old, eps = value[at], 1e-3
        value[at] = old + eps
        up = (net.forward(x, first, size) * slope).sum()
        value[at] = old - eps
        down = (net.forward(x, first, size) * slope).sum()
        value[at] = old
        assert np.atleast_1d(grads[name])[at] == pytest.approx((up - down) / (2 * eps), rel=0.02, abs=1e-3), name


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 57, 200):
        first, size, text = toxicity.windows(np.array([3, n]))
        own = text == 1
        covered = {p for a, k in zip(first[own], size[own]) for p in range(a, a + k)}
        assert covered == set(range(3, 3 + n)) and (size <= toxicity.WINDOW).all()


def test_toxic_texts_are_told_apart(spark):
    rng = np.random.default_rng(3)
    text = lambda bad: " ".join(["vile" + "xyz"[rng.integers(3)] if bad and k % 50 == 20 else f"w{rng.integers(300)}" for k in range(rng.integers(30, 200))])
    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(700)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (None, "a b")], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.train(*toxicity.labelled_sample(docs, labels))
    got = {r.doc_id: r.own for r in docs.select("doc_id", toxicity.score("text", model).alias("own")).collect()}
    assert got[1000] == got[1001] == 0.0 and len(got) == 703
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i % 5 == 0]
    assert np.mean(held) > 0.97
    assert toxicity.train(["a"], [1]) is None
    assert docs.limit(3).select(toxicity.score("text", None).alias("s")).agg(F.sum("s")).first()[0] == 0


def test_scores_are_those_of_single_texts(spark):
    model = toxicity.train(["good day"] * 3 + ["bad word here"] * 3, [0] * 3 + [1] * 3, epochs=1)
    texts = ["bad word", "x " * 500 + "bad word", None, "", "good"]
    together = model.scores(pa.array(texts))
    assert together.tolist() == pytest.approx([float(model.scores(pa.array([t], pa.string()))[0]) for t in texts], abs=1e-6)


TEXTS = [
    "mail bosbt.42@mail8.example.com, tel +1 (988) 555-2485 or 988-555-2485; card 4041894974608795 and 4041-8949-7460-8795",
    "ip 42.144.35.254 and 300.1.1.1, ssn 123-45-6789 and 666-12-1234, bad card 4041894974608796",
    "2024-02-29 2023-02-29 01.02.2003 31/12/1999 12/31/1999", None, "", "no digits", "x@y.z 12345", "1" * 40, "a.b+c@d-e.org averyveryverylonglocalpart1234567890@x.com",
]


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pseudonyms_keep_format_and_links_and_turn_back(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").withColumn("l", F.lit(1)).withColumn("r", F.lit(2))
    rows = df.withColumn("p", pseudonyms.pseudonymise("t", "k")).withColumn("back", pseudonyms.pseudonymise("p", "k", True)).withColumn("q", pseudonyms.pseudonymise("t", "j")).orderBy("i").collect()
    assert [r.back for r in rows] == TEXTS
    first, second, third = (r.p for r in rows[:3])
    assert first != rows[0].q
    cards = re.findall(r"card (\d+) and ([\d-]+)", first)[0]
    assert cards[0] == cards[1].replace("-", "") != "4041894974608795" and luhn(cards[0])
    phones = re.findall(r"\+1 (\(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})", first)[0]
    assert re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1]) != "9885552485"
    assert re.search(r"mail [a-z0-9]{5}\.[a-z0-9]{2}@mail8\.example\.com", first) and "bosbt.42" not in first
    assert "300.1.1.1" in second and "666-12-1234" in second and "4041894974608796" in second
    assert "42.144.35.254" not in second and "123-45-6789" not in second
    days = third.split()
    assert days[1] == "2023-02-29" and days[4] == "12/31/1999" and date.fromisoformat(days[0])
    assert [r.p for r in rows[3:8]] == [None, "", "no digits", rows[6].p, "1" * 40] and rows[6].p.endswith("@y.z 12345")


def test_permutation_hits_every_value_once(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert df.select(pseudonyms.permuted_digits(F.col("d"), F.lit("k"), "t", False).alias("p")).distinct().count() == 1000
    with pytest.raises(ValueError):
        pseudonyms.pseudonymise("t", "")


def test_pseudonyms_use_no_python(spark, sf01):
    plan = queries.op7_pseudonyms(spark, sf01)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
