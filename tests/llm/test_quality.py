"""Held-out accuracy and edge cases of the quality classifier."""
import zlib

import numpy as np
import pytest

from bidscope.llm import quality as Q
from bidscope.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op8_random_indexing"](spark, d).toPandas()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    both = got[got.held_out].merge(spark.read.parquet(f"{d}/labels.parquet").toPandas(), on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.93


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b c", "x"), (3, "a b c", "x"), (None, "Ha Ha Ha " * 30000, "x"), (4, " \n", "x")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(3, 1), (3, 1), (1, None), (None, 0), (9, 0)], "doc_id long, quality int")
    out = Q.classify(spark, docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 4)}) == 1
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert Q.classify(spark, docs.limit(0), labels.limit(0)).count() == 0
    model = Q.fit(docs, labels)
    assert dict(Q.score(docs, model).dtypes)["score"] == "double"
    with pytest.raises(ValueError):
        Q.score(docs.drop("text"), model)


def test_contexts_equal_a_plain_count(spark):
    texts = ["a b c a", "b", None, "c  c"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    fixed = Q.fixed_vectors()
    import pyarrow as pa
    total = np.zeros(fixed.shape)
    for t in texts:
        _, words, looks = Q.slots(pa.array([t], pa.string()))
        for stream in (words, looks):
            for a, b in zip(stream, stream[1:]):
                total[a] += fixed[b]
                total[b] += fixed[a]
    want = fixed / np.maximum(np.linalg.norm(fixed, axis=1, keepdims=True), 1) + total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    assert np.allclose(Q.word_vectors(docs), want, atol=1e-5)


def test_temperature_and_classes():
    rng = np.random.default_rng(0)
    x = np.hstack([rng.normal(size=(400, Q.FEATURES)), np.full((400, 1), 1000.0)])
    y = (x[:, 0] + rng.normal(0, 1, 400) > 0).astype(float)
    kept = np.arange(400) % 4 == 0
    net = Q.train(x, y, kept)
    loss = lambda t: np.logaddexp(0, -(2 * y[kept] - 1) * net.logits(x[kept]) / t).mean()
    assert loss(net.temperature) <= loss(1.0)
    only = Q.train(x, np.ones(400), kept)
    assert (only.score(x) > 0.9).all()
