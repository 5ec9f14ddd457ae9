"""The field against enumeration, spans against a regex, held-out accuracy."""
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from bidscope.llm import toxicity as X
from bidscope.llm.queries import QUERIES


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    for sizes in ([1], [0, 4, 0, 3, 1], [9, 2], [0], []):
        starts = np.concatenate(([0], np.cumsum(sizes))).astype(int)
        weights, chain = rng.normal(0, 2, starts[-1]), X.Chain(*rng.normal(0, 1, 4).tolist())
        got = X.recursions(weights, starts, chain)[2]
        for a, b in itertools.pairwise(starts.tolist()):
            mass, total = np.zeros(b - a), 0.0
            for tags in itertools.product((0, 1), repeat=b - a):
                value = sum(w for w, t in zip(weights[a:b], tags) if t) + (chain.first if tags and tags[0] else 0)
                value += sum({(0, 1): chain.into, (1, 0): chain.out, (1, 1): chain.stay}.get(p, 0.0) for p in itertools.pairwise(tags))
                total += math.exp(value)
                mass += math.exp(value) * np.array(tags)
            np.testing.assert_allclose(got[a:b], mass / total, rtol=1e-9)


def test_extreme_weights_stay_finite():
    weights = np.tile([1e9, -1e9, 0.0], 5000)
    got = X.recursions(weights, np.array([0, 7, len(weights)]), X.Chain(-30, -20, 20, 5))[2]
    assert np.isfinite(got).all() and got.min() >= 0 and got.max() <= 1


def test_tokens_are_those_of_the_rule():
    texts = ["Bad WORD, bad!", "", None, "é漢 x-1", "abc", "def ", "  ", "A\x00b c"]
    found = X.tokens(pa.array(texts))
    for i, text in enumerate(texts):
        own = found.codes[found.starts[i]:found.starts[i + 1]]
        assert [found.words[c] for c in own] == re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def made(n):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{k}" for k in rng.integers(0, 300, rng.integers(3, 60))]
        toxic = bool(rng.random() < 0.2)
        for _ in range(3 * toxic):
            words[rng.integers(len(words))] = rng.choice(["vile", "rotten"]) + ("" if rng.random() < .5 else f"{rng.integers(1000)}")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_spans_and_edges(spark):
    rows, labels = made(900)
    model = X.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    texts = ["w1 w2 vile w3", "é ROTTEN vile7 w5 漢 vile.", "", None, "w1 " * 300_000 + "vile", "w9 w8", "w9 w8"]
    df = spark.createDataFrame([(i if i != 2 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string").selectExpr("*", "1 as spans")
    got = X.score(df.repartition(3), model).collect()
    assert len(got) == len(texts)
    by_text = {r.text: r for r in got}
    for text, row in by_text.items():
        marked = [(text or "")[s.begin:s.end] for s in row.spans]
        assert re.findall(r"vile\d*|rotten\d*", " ".join(marked).lower()) == re.findall(r"vile\d*|rotten\d*", (text or "").lower())
    assert [(text or "x")[s.begin:s.end] for text in texts[:1] for s in by_text[text].spans] == ["vile"]
    assert by_text[texts[0]].predicted == 1 and by_text["w9 w8"].predicted == 0
    assert by_text[""].score == by_text[None].score and not by_text[None].spans
    assert X.score(df.limit(0), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, None)], [(0, 1), (1, 1)], [(0, 0)]])
def test_without_both_labels_the_score_is_constant(spark, labels):
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(8)] + [(None, None), (3, "again")], "doc_id long, text string")
    model = X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len({r.score for r in X.score(docs, model).collect()}) == 1


def test_held_out(spark):
    d = "/root/testdata/sf0.1"
    got = QUERIES["op12_crf"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    held = got.where("held_out").toPandas()
    right = held.predicted == held.toxic
    assert len(held) > 900 and right.mean() > 0.97
    assert right[held.toxic == 1].mean() > 0.93      # the rest has no toxic word: labels at random
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "toxic"]
