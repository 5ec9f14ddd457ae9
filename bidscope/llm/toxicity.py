"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of ASCII letters, digits and all characters beyond ASCII,
lower-cased.  Each is clean or toxic; the field weighs a token's word and the
first characters of it, and how one tag follows the other.  With two tags the
forward and the backward recursions are fractions of linear functions of one
number, the odds, so a slice of texts is one chain whose steps are combined in
blocks with numpy; a text's first token forgets what was before.

Only documents are labelled, so the labelled tokens that the field is fitted
on are made from them: a token of a toxic document is toxic if its word or
one of its beginnings is found in toxic documents far more often than in
others.  A document's score is a logistic function of the expected number of
toxic tokens, the greatest marginal and the number of tokens, calibrated on
documents that the field was not fitted on.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidscope.llm.columns import require, with_columns
from bidscope.llm.quality import fold
from bidscope.llm.words import ALNUM, LOWER, mix, text_buffers

TRAINED_ON, TRAINED_BYTES = 3000, 4 << 20      # labelled documents and bytes of text at most, of each label, by the smallest hash of doc_id
PREFIXES = (3, 4, 5, 6)                        # characters
FOUND, LIFT, SURE = 4, 4.0, 4.0                # toxic documents, times as often as in others, standard errors: of a sign of toxic tokens
KNOWN = 12                                     # documents from which a word counts by itself and not by its beginnings
EPOCHS, RATE, DECAY = 60, 0.3, 1e-3
LIMIT = 30.0                                   # of a token's weight, which keeps odds finite
REMEMBERED = 500_000                           # words whose weight a task remembers
MARKED = 0.5                                   # marginal from which a token belongs to a span


class Tokens(NamedTuple):
    codes: np.ndarray        # of each token, an index into words
    words: list[str]
    starts: np.ndarray       # of each text, its first token; one more at the end
    begins: np.ndarray       # bytes from the start of the slice
    ends: np.ndarray


def tokens(texts: pa.Array) -> Tokens:
    data, offsets = text_buffers(texts)
    inside = ALNUM[LOWER[data]]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = edge == 1, edge == -1
    at = offsets[1:-1]                         # a word that touches the next text's first one
    touching = at[(at > 0) & (at < len(data))]
    touching = np.unique(touching[inside[touching] & inside[touching - 1]])
    first[touching] = last[touching] = True
    begins, ends = np.flatnonzero(first), np.flatnonzero(last)
    kept = LOWER[data[inside]]
    places = np.concatenate(([0], np.cumsum(ends - begins))).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(places), pa.py_buffer(kept)]).dictionary_encode()
    words = [w.decode("utf-8", "replace").lower() for w in found.dictionary.to_pylist()]
    return Tokens(found.indices.to_numpy(zero_copy_only=False), words, np.searchsorted(begins, offsets), begins, ends)


def features(word: str) -> list[str]:
    """The whole word, and its beginnings that are marked as such."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) >= n]


def odds(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x after each step x -> (b + d x) / (a + c x), from x = 0 on.  Steps are
    combined in about sqrt(n) blocks of sqrt(n)."""
    n = len(a)
    if not n:
        return np.empty(0)
    size = math.isqrt(n - 1) + 1
    pad = -n % size
    a, b, c, d = (np.concatenate((x, np.full(pad, one))).reshape(-1, size).T.copy() for x, one in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    p, q, r, s = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for k in range(1, size):                   # x -> (q + s x) / (p + r x), then step k
        p, q, r, s = a[k] * p + c[k] * q, b[k] * p + d[k] * q, a[k] * r + c[k] * s, b[k] * r + d[k] * s
        scale = 1 / np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    x, enter = 0.0, []
    for p1, q1, r1, s1 in zip(p.tolist(), q.tolist(), r.tolist(), s.tolist()):
        enter.append(x)
        x = (q1 + s1 * x) / (p1 + r1 * x)
    out = np.empty((size, len(enter)))
    x = np.array(enter)
    for k in range(size):
        x = (b[k] + d[k] * x) / (a[k] + c[k] * x)
        out[k] = x
    return out.T.ravel()[:n]


class Chain(NamedTuple):
    """Weights of tags that follow each other (clean after clean weighs 0)."""
    first: float             # a text's first token is toxic
    into: float              # toxic after clean
    out: float               # clean after toxic
    stay: float              # toxic after toxic


def recursions(weights: np.ndarray, starts: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of toxic tags from the tokens up to each (forward), from those
    from each on (backward), and the marginals."""
    n = len(weights)
    e = np.exp(np.clip(weights, -LIMIT, LIMIT))
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    full = starts[:-1][np.diff(starts) > 0]
    first[full] = True
    last[starts[1:][np.diff(starts) > 0] - 1] = True
    into, out, stay = math.exp(chain.into), math.exp(chain.out), math.exp(chain.stay)
    step = lambda reset, b, c: (np.ones(n), np.where(reset, e, e * b), np.where(reset, 0, c), np.where(reset, 0, e * stay))
    a, b, c, d = step(first, into, out)
    b[first] *= math.exp(chain.first)
    forward = odds(a, b, c, d)
    backward = odds(*[x[::-1] for x in step(last, out, into)])[::-1]
    both = forward * backward / e
    return forward, backward, both / (1 + both)


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float
    chain: Chain
    mean: np.ndarray
    scale: np.ndarray
    slope: np.ndarray
    offset: float

    def word(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.slope + self.offset, -500, 500)))


def document_features(marginals: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n = np.diff(starts)
    out = np.zeros((len(n), 3))
    full = n > 0
    if full.any():
        at = starts[:-1][full]
        expected = np.add.reduceat(marginals, at)
        out[full, 0] = np.log(expected + 1e-3) - math.log(1e-3)
        out[full, 1] = np.maximum.reduceat(marginals, at)
    out[:, 2] = np.log1p(n)
    return out


def signs(found: Tokens, toxic: np.ndarray) -> np.ndarray:
    """Words that are signs of toxicity: they, or if they are too rare to
    tell, their beginnings, are far more often in toxic documents."""
    owner = np.repeat(np.arange(len(toxic)), np.diff(found.starts))
    pairs = np.unique(owner * len(found.words) + found.codes) if len(owner) else np.empty(0, np.int64)
    documents: list[Counter] = [Counter(), Counter()]
    own, label = set(), None
    for pair in pairs.tolist():
        doc, code = divmod(pair, len(found.words))
        if doc != label:
            if label is not None:
                documents[int(toxic[label])].update(own)
            own, label = set(), doc
        own.update(features(found.words[code]))
    if label is not None:
        documents[int(toxic[label])].update(own)
    n1, n0 = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    out = set()
    for f, k in documents[1].items():
        other = documents[0][f]
        share, error = (k + other) / (n1 + n0), 1 / n1 + 1 / n0
        apart = k / n1 - other / n0
        if k >= FOUND and k / n1 >= LIFT * other / n0 and apart >= SURE * math.sqrt(share * (1 - share) * error):
            out.add(f)
    common = lambda w: documents[0][w] + documents[1][w] >= KNOWN
    return np.array([w in out if common(w) else any(f in out for f in features(w)) for w in found.words], bool)


def _adam(shapes: list, slope, epochs: int, rate: float):
    w = [np.zeros(s) for s in shapes]
    m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for epoch in range(epochs):
        now = rate * 0.5 * (1 + math.cos(math.pi * epoch / epochs))
        for i, g in enumerate(slope(w)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            w[i] = w[i] - now * (m[i] / (1 - 0.9 ** (epoch + 1))) / (np.sqrt(v[i] / (1 - 0.99 ** (epoch + 1))) + 1e-12)
    return w


def fit_field(found: Tokens, toxic: np.ndarray) -> tuple[dict[str, float], float, Chain]:
    """Weights of the features that some sign of toxicity shares a word with,
    the weight of any toxic tag, and those of tags that follow each other:
    maximum likelihood of the labelled tokens by full gradients."""
    marked = signs(found, toxic)
    shared = {f for code in np.flatnonzero(marked).tolist() for f in features(found.words[code])}
    owner = np.repeat(np.arange(len(toxic)), np.diff(found.starts))
    tag = marked[found.codes] & toxic[owner] if len(owner) else np.empty(0, bool)
    if not tag.any():
        return {}, -LIMIT, Chain(0.0, 0.0, 0.0, 0.0)
    names, word_of, feature_of = {}, [], []
    for code, word in enumerate(found.words):
        for f in shared.intersection(features(word)):
            word_of.append(code)
            feature_of.append(names.setdefault(f, len(names)))
    word_of, feature_of = np.array(word_of), np.array(feature_of)
    follows = np.ones(len(tag), bool)
    follows[found.starts[:-1][np.diff(found.starts) > 0]] = False
    now, before = tag[follows], tag[np.flatnonzero(follows) - 1]
    seen = np.array([(tag & ~follows).sum(), (now & ~before).sum(), (~now & before).sum(), (now & before).sum()], float)

    def slope(w):
        by_word = np.bincount(word_of, w[0][feature_of], len(found.words)) + w[1]
        chain = Chain(*w[2].tolist())
        forward, backward, p = recursions(by_word[found.codes], found.starts, chain)
        wrong = np.bincount(found.codes, p - tag, len(found.words))
        r, y = forward[np.flatnonzero(follows) - 1], backward[follows]
        ways = np.stack([math.exp(chain.into) * y, math.exp(chain.out) * r, math.exp(chain.stay) * r * y])
        ways = (ways / (1 + ways.sum(0))).sum(1)
        expected = np.concatenate(([p[~follows].sum()], ways))
        scale = 1 / max(tag.sum(), 1)
        return [scale * np.bincount(feature_of, wrong[word_of], len(names)) + DECAY * w[0], scale * wrong.sum(),
                scale * (expected - seen) + DECAY * w[2]]

    w = _adam([len(names), (), 4], slope, EPOCHS, RATE)
    return dict(zip(names, w[0].tolist())), float(w[1]), Chain(*w[2].tolist())


def train(texts: list, toxic: np.ndarray, kept: np.ndarray, weight: np.ndarray) -> Model:
    """``kept`` documents calibrate the score, the others fit the field;
    ``weight`` is what each one stands for.  Without both labels the score is
    constant."""
    share = (weight[toxic].sum() + 1) / (weight.sum() + 2)
    none = Model({}, -LIMIT, Chain(0.0, 0.0, 0.0, 0.0), np.zeros(3), np.ones(3), np.zeros(3), math.log(share / (1 - share)))
    if toxic.all() or not toxic.any():
        return none
    both = lambda rows: toxic[rows].any() and not toxic[rows].all()
    if not (both(kept) and both(~kept)):
        kept = np.ones(len(toxic), bool)
        use = kept
    else:
        use = ~kept
    of = lambda rows: pa.array([t for t, k in zip(texts, rows) if k], pa.large_string())
    model = none._replace(**dict(zip(("weights", "bias", "chain"), fit_field(tokens(of(use)), toxic[use]))))
    found = tokens(of(kept))
    by_word = np.array([model.word(w) for w in found.words])
    x = document_features(recursions(by_word[found.codes] if len(found.codes) else np.empty(0), found.starts, model.chain)[2], found.starts)
    y, each = toxic[kept].astype(float), weight[kept] / weight[kept].sum()
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale

    def slope(w):
        wrong = (1 / (1 + np.exp(-np.clip(z @ w[0] + w[1], -500, 500))) - y) * each
        return [z.T @ wrong + 1e-4 * w[0], wrong.sum()]

    w = _adam([3, ()], slope, 600, 0.1)
    return model._replace(mean=mean, scale=scale, slope=w[0], offset=float(w[1]))


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", most: int = TRAINED_ON, most_bytes: int = TRAINED_BYTES) -> Model:
    """The field and the score from labelled rows that are not held out (fold
    of doc_id modulo 4 is not 2): of each label at most ``most`` documents and
    ``most_bytes`` of their texts, in order of the hash of doc_id.  Null labels
    are left out; of several labels of a document the smallest counts.  What
    each label's documents stand for are all labelled documents."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", target)
    known = labels.where(F.col(target).isNotNull() & (fold(F.col("doc_id"), 4) != 2)).groupBy("doc_id").agg(F.min(target).cast("int").alias("label"))
    sizes = docs.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")).join(known, "doc_id")
    stood = {r.label: r.n for r in sizes.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = None
    for label in (0, 1):
        some = sizes.where(F.col("label") == label).orderBy(*order).limit(most)
        some = some.withColumn("before", F.sum("bytes").over(Window.orderBy(*order)))      # over at most ``most`` rows
        first = some if first is None else first.unionByName(some)
    sample = first.where(F.col("before") <= most_bytes).select("doc_id", "label", F.xxhash64("doc_id").alias("hash"))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("hash", "label", "text").collect()
    rows.sort(key=lambda r: (r.hash, r.text or ""))
    toxic = np.array([r.label == 1 for r in rows], bool)
    kept = mix(np.array([r.hash for r in rows], np.int64).astype(np.uint64)) % np.uint64(3) == 0
    n = {k: max(int((toxic == bool(k)).sum()), 1) for k in (0, 1)}
    weight = np.array([stood[r.label] / n[r.label] for r in rows])
    return train([r.text or "" for r in rows], toxic, kept, weight)


def _spans(found: Tokens, marginals: np.ndarray, texts: pa.Array) -> pa.Array:
    """Runs of marked tokens as (begin, end) in code points of their text."""
    at = np.flatnonzero(marginals >= MARKED)
    owner = np.searchsorted(found.starts, at, "right") - 1
    if len(at):
        new = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(owner) > 0)))
        last = np.concatenate((new[1:], [True]))
    else:
        new = last = np.empty(0, bool)
    data, offsets = text_buffers(texts)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    base = chars[offsets[owner[new]]]
    begin, end = chars[found.begins[at[new]]] - base, chars[found.ends[at[last]]] - base
    counts = np.bincount(owner[new], minlength=len(texts)) if len(at) else np.zeros(len(texts), int)
    places = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    return pa.ListArray.from_arrays(places, pa.StructArray.from_arrays([pa.array(begin, pa.int64()), pa.array(end, pa.int64())], ["begin", "end"]))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (probability that the document is toxic),
    ``predicted`` (1 from ``threshold`` on) and ``spans``, the toxic parts of
    the text as (begin, end) in code points.  Only the text counts: equal texts
    have equal scores; null and empty ones have no spans and the score of no
    tokens.  Long texts are read whole, columns with clashing names are
    replaced.  One pass, no shuffle."""
    require(docs, "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known: dict[str, float] = {}

    def make(part: pa.RecordBatch) -> list:
        model, text = shared.value, part.column("text")
        found = tokens(text)
        if len(known) > REMEMBERED:
            known.clear()
        by_word = np.empty(len(found.words))
        for i, w in enumerate(found.words):
            got = known.get(w)
            if got is None:
                got = known[w] = model.word(w)
            by_word[i] = got
        marginals = recursions(by_word[found.codes] if len(found.codes) else np.empty(0), found.starts, model.chain)[2]
        p = model.score(document_features(marginals, found.starts))
        return [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32)), _spans(found, marginals, text)]

    return with_columns(docs, "text", "score double, predicted int, spans array<struct<begin:long,end:long>>", make, keep)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on ``labels`` and score every document: doc_id, held_out, score,
    predicted, spans."""
    return score(docs, fit(docs, labels), keep=["doc_id"]).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "spans")
