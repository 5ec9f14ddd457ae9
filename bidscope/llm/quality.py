"""Quality classifier: random indexing, pooling, a small numpy network.

Random indexing gives every word a fixed sparse vector of +1 and -1 and, as
its context vector, the sum of the fixed vectors of its neighbours over the
whole corpus.  Words are hashed to a fixed number of slots, so the table of
context vectors has a size that no corpus changes.  Next to the words runs a
second stream, their shapes (case, symbols, length, digits, repeat of an
earlier word), indexed alike.  A document is the mean of its words' vectors
and of its shapes' vectors.  A two-layer network scores that, and a
temperature fitted on rows kept from training calibrates the probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm import sums
from bidscope.llm.columns import give_back, require, with_columns
from bidscope.llm.words import KEEP, hashes, mix, owners, slices, split_words, text_buffers, Words

WORD_SLOTS, SHAPE_SLOTS, BLOCK = 4096, 512, 512
DIMS, ONES = 32, 4                   # of a vector; of them not 0 in a fixed vector
TRAINED_ON = 20_000                  # labelled rows at most, by the smallest hash of doc_id
HIDDEN, EPOCHS, RATE, DECAY, SEED = 32, 60, 0.01, 1e-4, 7
PRIOR = 6                            # words of an average text that every text is taken to have besides its own
FEATURES = 2 * DIMS                  # of words and of shapes; one more number is how many words there are


def fixed_vectors() -> np.ndarray:
    """ONES of DIMS entries are +1 or -1, by a seeded hash of the slot."""
    slots = np.arange(WORD_SLOTS + SHAPE_SLOTS, dtype=np.uint64)
    out = np.zeros((len(slots), DIMS), np.int64)
    for k in range(ONES):
        h = mix(slots * np.uint64(2 * ONES + 1) + np.uint64(k + SEED))
        at = (h % np.uint64(DIMS)).astype(int)
        out[np.arange(len(slots)), at] += 1 - 2 * ((h >> np.uint64(40)) & np.uint64(1)).astype(int)
    return out


def shapes(vocab: pa.Array) -> np.ndarray:
    """A number below SHAPE_SLOTS / 2 for how a word looks."""
    data, offsets = text_buffers(vocab)
    if not len(vocab):
        return np.empty(0, np.int64)
    at = offsets[:-1]
    count = lambda inside: np.add.reduceat(inside.astype(np.int32), at)
    upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    letter = upper | (data >= 97) & (data <= 122) | (data >= 128)
    n_upper, n_digit, n_letter, size = count(upper), count(digit), count(letter), np.diff(offsets)
    n_symbol = size - n_digit - n_letter
    case = np.select([n_letter == 0, n_upper == 0, (n_upper == 1) & upper[at], n_upper == n_letter], [0, 1, 2, 3], 4)
    symbol = np.select([n_symbol == 0, n_symbol == 1, n_symbol == 2], [0, 1, 2], 3)
    length = np.searchsorted([2, 4, 8, 13], size, "right")
    return ((case * 4 + symbol) * 5 + length) * 2 + (n_digit > 0)


def slots(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, and the slots of each one's word and shape."""
    words = split_words(texts, KEEP)
    low = pa.array([w.lower() for w in words.vocab.to_pylist()], pa.large_binary())
    of_word = (hashes(low) % np.uint64(WORD_SLOTS)).astype(np.int64)
    codes, text = words.codes, owners(words.starts)
    again = np.zeros(len(codes), np.int64)
    for back in (1, 2):
        again[back:] |= (codes[back:] == codes[:-back]) & (text[back:] == text[:-back])
    return words, of_word[codes], WORD_SLOTS + 2 * shapes(words.vocab)[codes] + again


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fixed, total = fixed_vectors(), np.zeros((WORD_SLOTS + SHAPE_SLOTS) * DIMS, np.int64)
    where = np.argsort(-np.abs(fixed), axis=1, kind="stable")[:, :ONES]
    value = np.take_along_axis(fixed, where, 1).astype(np.float64)
    for batch in batches:
        for part in slices(batch, "text"):
            words, a, b = slots(part.column("text"))
            text = owners(words.starts)
            inside = text[1:] == text[:-1]
            for stream in (a, b):
                left, right = stream[:-1][inside], stream[1:][inside]
                for to, of in ((left, right), (right, left)):
                    for k in range(ONES):
                        total += np.bincount(to * DIMS + where[of, k], value[of, k], len(total)).astype(np.int64)
    yield sums.parts(total, BLOCK * DIMS)
    give_back()


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The context vectors of all slots over all rows: a fixed number of
    entries."""
    total = sums.total(docs.select("text").mapInArrow(_count_contexts, sums.SCHEMA), (WORD_SLOTS + SHAPE_SLOTS) * DIMS)
    total = total.reshape(-1, DIMS).astype(np.float64)
    size = np.linalg.norm(total, axis=1, keepdims=True)
    fixed = fixed_vectors()
    return (fixed / np.maximum(np.linalg.norm(fixed, axis=1, keepdims=True), 1) + total / np.maximum(size, 1)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """FEATURES numbers for each text, zeros where it has no words, and its
    number of words."""
    words, a, b = slots(texts)
    n = np.diff(words.starts)
    out = np.zeros((len(n), FEATURES + 1), np.float32)
    out[:, -1] = n
    full = np.flatnonzero(n)
    step = 1 << 18                    # words in one gather
    for at, stream in ((0, a), (DIMS, b)):
        sums = np.zeros((len(n), DIMS))
        for begin in range(0, len(stream), step):
            piece = vectors[stream[begin:begin + step]]
            first = np.searchsorted(words.starts, begin, "right") - 1
            last = np.searchsorted(words.starts, begin + len(piece), "left")
            rows = np.arange(first, last)
            rows = rows[n[rows] > 0]
            cuts = np.maximum(words.starts[rows] - begin, 0)
            sums[rows] += np.add.reduceat(piece, cuts, axis=0)
        out[full, at:at + DIMS] = sums[full] / n[full, None]
    return out


class Network(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(_inputs(x, self.mean, self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -500, 500)))


def _inputs(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Deviations from the average text; few words say less than many."""
    n = x[:, -1:]
    return (x[:, :-1] - mean) / scale * (n / (n + PRIOR))


def train(x: np.ndarray, y: np.ndarray, kept: np.ndarray) -> Network:
    """Adam on the log loss of the rows that are not ``kept``; the kept ones
    choose the temperature.  Without both classes the score is constant."""
    rng = np.random.default_rng(SEED)
    x = x.astype(np.float64)
    mean = x[:, :-1].mean(0) if len(x) else np.zeros(FEATURES)
    scale = x[:, :-1].std(0) + 1e-6 if len(x) else np.ones(FEATURES)
    w = [rng.normal(0, 1 / math.sqrt(FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(())]
    share = (y.sum() + 1) / (len(y) + 2)
    if y.size == 0 or y.min() == y.max():
        return Network(mean, scale, w[0], w[1], np.zeros(HIDDEN), math.log(share / (1 - share)), 1.0)
    fit = ~kept if (~kept).any() and np.unique(y[~kept]).size == 2 else np.ones(len(y), bool)
    xs, ys = _inputs(x, mean, scale)[fit], y[fit]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(ys))
        rate = RATE * 0.5 * (1 + math.cos(math.pi * epoch / EPOCHS))
        for at in range(0, len(order), 256):
            rows = order[at:at + 256]
            hidden = np.tanh(xs[rows] @ w[0] + w[1])
            wrong = (1 / (1 + np.exp(-np.clip(hidden @ w[2] + w[3], -500, 500))) - ys[rows]) / len(rows)
            back = wrong[:, None] * w[2] * (1 - hidden ** 2)
            slope = [xs[rows].T @ back + DECAY * w[0], back.sum(0), hidden.T @ wrong + DECAY * w[2], wrong.sum()]
            step += 1
            for i, g in enumerate(slope):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, w[0], w[1], w[2], float(w[3]), 1.0)
    rows = kept if kept.any() else fit
    raw, sign = net.logits(x[rows]), 2 * y[rows] - 1
    grid = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, -sign * raw / t).mean() for t in grid]
    return net._replace(temperature=float(grid[int(np.argmin(loss))]))


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; that of a null key is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", most: int = TRAINED_ON) -> tuple[np.ndarray, Network]:
    """Vectors from all texts of ``docs``, and the network from labelled rows
    that are not held out (the fold of doc_id modulo 5 is not 0): at most
    ``most``, those with the smallest hash of their doc_id.  Null labels are
    left out; of several labels of a document the smallest counts."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", target)
    vectors = word_vectors(docs)
    known = labels.where(F.col(target).isNotNull() & (fold(F.col("doc_id"), 5) != 0)).groupBy("doc_id").agg(F.min(target).alias("label"))
    sample = known.join(docs.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    make = lambda part: [_rows(pooled(part.column("text"), shared.value))]
    got = sorted(with_columns(rows, "text", "features array<float>", make, ["doc_id", "label"]).collect())
    x = np.array([r.features for r in got], np.float32).reshape(len(got), FEATURES + 1)
    y = np.array([r.label for r in got], np.float64)
    kept = mix(np.array([r.doc_id for r in got], np.int64).astype(np.uint64)) % np.uint64(5) == 0
    return vectors, train(x, y, kept)


def _rows(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))


def score(docs: DataFrame, model: tuple[np.ndarray, Network], threshold: float = 0.3,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted``
    (1 from ``threshold`` on).  Only the text counts: equal texts have equal
    scores, null and empty ones the score of no words.  Long texts are read
    whole, columns with clashing names are replaced.  One pass, no shuffle."""
    require(docs, "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(part: pa.RecordBatch) -> list:
        vectors, net = shared.value
        p = net.score(pooled(part.column("text"), vectors))
        return [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))]

    return with_columns(docs, "text", "score double, predicted int", make, keep)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on ``labels`` and score every document: doc_id, held_out, score,
    predicted."""
    model = fit(docs, labels)
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
