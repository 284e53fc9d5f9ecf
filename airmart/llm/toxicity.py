"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling.

Each word enters as a word input and three character inputs. The word input is
the log-odds of its hash, the character inputs are the highest, mean and lowest
log-odds of its byte n-grams (with marks for word begin and end). In training a
text's log-odds are counted over the other folds of the labelled texts, so that
the network learns how far they can be trusted. It reads windows of
32 words, 24 apart, the last one ending with the text; the highest window makes
the score of a text. Training picks the window of a toxic text that its current
weights find likeliest, twice anew. Last, a logistic curve over the highest
windows puts the boundary at 0.5.

`labelled_sample` takes a bounded, documented number of labelled rows to the
driver for training. Everything else runs over all rows: a text is scored whole.

A null text or one without words scores 0. Rows with a null or unlabelled id are
scored like all others. Repeated rows and other columns stay as they are. With
no labelled text of one of the classes, every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from airmart.llm.words import Spans, Words, blocks, mixed

WINDOW, STEP, HIDDEN, INPUTS = 32, 24, 8, 4
GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
MAX_ROWS_PER_CLASS = 1500
MAX_TEXT_BYTES = 20_000
AT_ONCE = 4096
FOLDS = 5
BLOCK = 1 << 20
_CODES = mixed(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS_PER_CLASS, max_bytes: int = MAX_TEXT_BYTES,
) -> tuple[list[str], list[int]]:
    """Texts and labels for training: of each class the `max_rows` labelled ids lowest by hash, without texts beyond `max_bytes`; of rows that share an id the smallest text.

    The chosen labels are at most twice `max_rows` ids, which bounds their broadcast.
    """
    ids = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).where("k is not null and y in (0, 1)").distinct()
    chosen = None
    for y in (0, 1):
        part = ids.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(max_rows)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.octet_length("t") <= max_bytes)
    # One text for each id and label, however many rows share them: that bounds what reaches the driver.
    rows = texts.join(F.broadcast(chosen), "k").groupBy("k", "y").agg(F.min("t").alias("t")).collect()
    rows.sort(key=lambda r: (r.k, r.y, r.t))
    return [r.t for r in rows], [r.y for r in rows]


class Inputs:
    """Log-odds of word hashes and of byte n-grams."""

    def __init__(self, words: np.ndarray, grams: np.ndarray):
        self.words, self.grams = words, grams

    @classmethod
    def fit(cls, texts: list[Words], labels: np.ndarray, fold: np.ndarray) -> list[Inputs]:
        """Over all texts but those of each fold in turn, and last over all."""
        folds = int(fold.max()) + 1
        seen = np.zeros((2, folds, 2, BUCKETS), np.int32)
        for words, y, k in zip(texts, labels, fold):
            if len(words):
                hashes, one = np.unique(words.hash, return_index=True)
                seen[0, k, y][np.unique(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)] += 1
                seen[1, k, y][np.unique(np.concatenate([b for b, _ in gram_buckets(words, one)]))] += 1
        size = np.array([np.bincount(labels[fold == k], minlength=2) for k in range(folds)])
        out = []
        for k in [*range(folds), None]:
            rest = [i for i in range(folds) if i != k] or [0]
            tables = []
            for clean, toxic in seen[:, rest].sum(1):
                total = size[rest].sum(0)
                odds = np.log((toxic + 0.5) / (total[1] + 1)) - np.log((clean + 0.5) / (total[0] + 1))
                tables.append((odds * (clean + toxic) / (clean + toxic + 4) / 3).astype(np.float32))
            out.append(cls(*tables))
        return out

    def of(self, words: Words) -> np.ndarray:
        """A row of inputs for every word."""
        hashes, one, code = np.unique(words.hash, return_index=True, return_inverse=True)
        x = np.zeros((len(one), INPUTS), np.float32)
        x[:, 0] = self.words[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)]
        top, low, total, n = (np.full(len(one), v, np.float32) for v in (-9, 9, 0, 0))
        for bucket, sizes in gram_buckets(words, one):
            has = np.flatnonzero(sizes)
            at = np.append(0, np.cumsum(sizes[has]))[:-1]
            odds = self.grams[bucket]
            if len(has):
                top[has] = np.maximum(top[has], np.maximum.reduceat(odds, at))
                low[has] = np.minimum(low[has], np.minimum.reduceat(odds, at))
                total[has] += np.add.reduceat(odds, at)
                n[has] += sizes[has]
        x[:, 1], x[:, 2], x[:, 3] = np.where(n, top, 0), total / np.maximum(n, 1), np.where(n, low, 0)
        return x[code]


def gram_buckets(words: Words, one: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n, the buckets of all n-grams of the words at `one`, word after word, and how many each word has."""
    sizes = words.end[one] - words.start[one]
    marked = sizes + 2
    ends = np.cumsum(marked)
    begins = ends - marked
    data = np.full(int(ends[-1]) if len(ends) else 0, 0, np.uint8)
    data[ends - 1] = 1
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data[np.repeat(begins + 1, sizes) + inner] = _LOWER[words.data[np.repeat(words.start[one], sizes) + inner]]
    spans = Spans(data, _CODES)
    for n in GRAMS:
        count = np.maximum(marked - n + 1, 0)
        at = np.repeat(begins, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        yield (mixed(spans.hash(at, at + n) + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64), count


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and text of every window of texts with `counts` words, laid one after another."""
    n = np.where(counts > WINDOW, -(-(counts - WINDOW) // STEP) + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    inside = np.minimum(k * STEP, np.maximum(counts[text] - WINDOW, 0))
    return inside + (np.cumsum(counts) - counts)[text], np.minimum(counts[text], WINDOW), text


@dataclass
class Network:
    """Weights; `gates` is for reset, update and new state, for each direction."""

    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w |= {f"in_{d}": rng.normal(0, 0.5, (INPUTS, 3 * HIDDEN)), f"state_{d}": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)), f"bias_{d}": np.zeros(3 * HIDDEN)}
        w |= {"attend": rng.normal(0, 0.3, 2 * HIDDEN), "out": rng.normal(0, 0.3, 2 * HIDDEN), "offset": np.zeros(1)}
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def forward(self, x: np.ndarray, first: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logit of each window of word inputs x; with what the backward pass needs if `keep`."""
        w, n = self.weights, len(first)
        length = int(size.max()) if n else 0
        inside = np.arange(length)[:, None] < size[None, :]
        place = np.where(inside, first[None, :] + np.arange(length)[:, None], 0)
        states = np.zeros((length, n, 2 * HIDDEN), np.float32)
        kept = {}
        for d, steps in (("f", range(length)), ("b", range(length - 1, -1, -1))):
            from_input, bias = w[f"in_{d}"], w[f"bias_{d}"]
            h = np.zeros((n, HIDDEN), np.float32)
            cols = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            kept[d] = []
            for t in steps:
                a, u = x[place[t]] @ from_input + bias, h @ w[f"state_{d}"]
                gate = np.tanh((a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN]) * np.float32(0.5))
                gate *= np.float32(0.5)
                gate += np.float32(0.5)
                r, z = gate[:, :HIDDEN], gate[:, HIDDEN:]
                new = np.tanh(a[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                after = new + z * (h - new)
                if not inside[t].all():
                    after = np.where(inside[t][:, None], after, h)
                if keep:
                    kept[d].append((t, h, r, z, new, u[:, 2 * HIDDEN :]))
                h = after
                states[t, :, cols] = h
        scores = np.where(inside, states @ w["attend"], np.float32(-1e9))
        share = np.exp(scores - scores.max(0)) if length else scores
        share /= np.maximum(share.sum(0), 1e-30)
        pooled = np.einsum("tn,tnh->nh", share, states)
        logit = pooled @ w["out"] + w["offset"][0]
        return (logit, (x, place, inside, states, share, pooled, kept)) if keep else logit

    def gradients(self, slope: np.ndarray, memory) -> dict[str, np.ndarray]:
        """Of the loss whose slope by each logit is given."""
        w, (x, place, inside, states, share, pooled, kept) = self.weights, memory
        g = {"out": pooled.T @ slope, "offset": np.array([slope.sum()])}
        by_pool = slope[:, None] * w["out"]
        by_share = np.einsum("nh,tnh->tn", by_pool, states)
        by_score = share * (by_share - (share * by_share).sum(0))
        g["attend"] = np.einsum("tn,tnh->h", by_score, states)
        by_state = share[:, :, None] * by_pool + by_score[:, :, None] * w["attend"]
        for d in "fb":
            cols = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            g_in, g_state, g_bias = (np.zeros_like(w[f"{k}_{d}"]) for k in ("in", "state", "bias"))
            back = np.zeros((states.shape[1], HIDDEN), np.float32)
            for t, h, r, z, new, u in reversed(kept[d]):
                on = inside[t][:, None]
                by_after = by_state[t, :, cols] + back
                live = np.where(on, by_after, 0)
                by_new = live * (1 - z) * (1 - new * new)
                by_gates = np.concatenate([by_new * u * r * (1 - r), live * (h - new) * z * (1 - z), by_new], 1)
                by_u = by_gates.copy()
                by_u[:, 2 * HIDDEN :] *= r
                g_in += x[place[t]].T @ by_gates
                g_bias += by_gates.sum(0)
                g_state += h.T @ by_u
                back = np.where(on, live * z + by_u @ w[f"state_{d}"].T, by_after)
            g |= {f"in_{d}": g_in, f"state_{d}": g_state, f"bias_{d}": g_bias}
        return g


@dataclass
class Model:
    inputs: Inputs
    network: Network
    scale: float
    shift: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for at, words in blocks(texts, BLOCK):
            if not len(words):
                continue
            x = self.inputs.of(words)
            first, size, text = windows(words.counts())
            logits = np.concatenate([self.network.forward(x, first[i : i + AT_ONCE], size[i : i + AT_ONCE]) for i in range(0, len(first), AT_ONCE)])
            best = np.full(len(words.off) - 1, -np.inf)
            np.maximum.at(best, text, logits)
            has = np.isfinite(best)
            out[at : at + len(best)][has] = 1 / (1 + np.exp(-(self.scale * best[has] + self.shift)))
        return out


def train(texts: list[str], labels: list[int], seed: int = 7, epochs: int = 8, rounds: int = 2) -> Model | None:
    """A model for labelled texts; None if a class is missing."""
    y = np.array(labels, np.int64)
    if len(np.unique(y)) < 2:
        return None
    rng = np.random.default_rng(seed)
    fold = np.zeros(len(y), np.int64)
    for c in (0, 1):
        own = np.flatnonzero(y == c)
        fold[rng.permutation(own)] = np.arange(len(own)) % min(FOLDS, np.bincount(y).min())
    words = [w for t in texts for _, w in blocks(pa.array([t]), 1)]
    *apart, inputs = Inputs.fit(words, y, fold)
    other = np.array([i for i in range(len(y)) if len(words[i])], np.int64)
    x = np.concatenate([apart[fold[i]].of(words[i]) for i in other]).astype(np.float32)
    first, size, text = windows(np.array([len(words[i]) for i in other]))
    target = y[other]
    rank = np.array([np.sort(x[a : a + n, :2].max(1))[-3:].sum() for a, n in zip(first, size)])
    network = Network.start(seed)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.weights.items()}
    step = 0
    for _ in range(rounds):
        order = np.lexsort((-rank, text))
        place = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        chosen = order[(place == 0) | (place < 2) & (target[text[order]] == 0)]
        spare = np.flatnonzero(target[text] == 0)
        chosen = np.concatenate([chosen, rng.choice(spare, min(len(spare), len(chosen) // 2), replace=False)])
        for _ in range(epochs):
            rng.shuffle(chosen)
            for i in range(0, len(chosen), 256):
                own = chosen[i : i + 256]
                logit, memory = network.forward(x, first[own], size[own], True)
                truth = target[text[own]]
                weight = np.where(truth == 1, 2.0, 1.0)
                slope = (weight * (1 / (1 + np.exp(-logit)) - truth) / len(own)).astype(np.float32)
                step += 1
                for k, grad in network.gradients(slope, memory).items():
                    m, v = moments[k]
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad * grad - v)
                    network.weights[k] = (network.weights[k] - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        rank = np.concatenate([network.forward(x, first[i : i + AT_ONCE], size[i : i + AT_ONCE]) for i in range(0, len(first), AT_ONCE)])
    best = np.full(len(other), -np.inf)
    np.maximum.at(best, text, rank)
    scale, shift = logistic(best, target)
    return Model(inputs, network, scale, shift)


def logistic(value: np.ndarray, truth: np.ndarray, decay: float = 0.05) -> tuple[float, float]:
    """Scale and shift of a logistic curve through 0/1 outcomes, by Newton's method."""
    a = np.stack([value, np.ones_like(value)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - truth) + decay * (w - [1, 0])
        h = (a * (p * (1 - p))[:, None]).T @ a + decay * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, g), -2, 2)
    return float(w[0]), float(w[1])


def score(texts: str | Column, model: Model | None) -> Column:
    """Score of each text, 0 to 1."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.scores(batch) if model else np.zeros(len(batch)))

    return scores(texts)
