"""The stored vector index: exact with all lists, recall with some."""
import numpy as np

from bidscope.operators import vectorindex as V
from bidscope.session import scratch_path


def test_exact_and_recall(spark, monkeypatch):
    monkeypatch.setattr(V, "PART", 150)               # the hot list is split
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 1500)] + rng.normal(0, 0.3, (1500, 16))
    x[:500] = centres[0] + rng.normal(0, 0.05, (500, 16))
    x[40] = x[20]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9000, [0.0] * 16), (9001, None)], "vec_id long, embedding array<double>")
    path = scratch_path(spark, "index-test")
    V.build(df, path, lists=20)
    lists = spark.read.parquet(f"{path}/lists")
    assert lists.count() == 1500 and lists.where("part > 0").count() > 300
    asked = df.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {i: sorted(range(1500), key=lambda j: (-round(float(unit[i] @ unit[j]), 12), j))[:10] for i in range(0, 1500, 20)}
    exact = {}
    for r in V.search(spark, path, asked, 10, None).orderBy("query", "rank").collect():
        exact.setdefault(r.query, []).append(r.key)
    assert set(exact) == set(want)
    assert np.mean([len(set(exact[i]) & set(want[i])) for i in want]) > 9.99
    some = {}
    for r in V.search(spark, path, asked, 10, 6).collect():
        some.setdefault(r.query, set()).add(r.key)
    assert np.mean([len(some[i] & set(want[i])) / 10 for i in want]) >= 0.9
    assert V.search(spark, path, asked.limit(0), 10).count() == 0


def test_recall_of_the_registered_search(spark):
    from bidscope.plans.registry import load_all
    plans, d = load_all(), "/root/testdata/sf0.1"
    exact = {(r.query_id, r.vec_id) for r in plans["vector_search_exact"].build(spark, d).collect()}
    found = {(r.query_id, r.vec_id) for r in plans["vector_search"].build(spark, d).collect()}
    assert len(exact) == 1000 and len(exact & found) / len(exact) >= 0.9


def test_exemplars_and_noise(spark):
    from pyspark.sql import functions as F

    from bidscope.operators import models as M
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(0, 0.1, (30, 3)), rng.normal(4, 0.1, (20, 3)), [[0.5, 0, 0], [3.0, 3, 3], [9.0, 9, 9]]])
    label = [0] * 30 + [1] * 20 + [-1] * 3
    core = rng.random(len(points))
    df = spark.createDataFrame([(i, c, v.tolist(), float(d)) for i, (c, v, d) in enumerate(zip(label, points, core))], "uid long, cluster int, v array<double>, core double")
    chosen = M.exemplars(df, F.col("core"), 5)
    picked = {c: sorted((i for i in range(53) if label[i] == c), key=lambda i: (core[i], i))[:5] for c in (0, 1)}
    assert sorted((r.cluster, tuple(r.exemplar)) for r in chosen.collect()) == sorted((c, tuple(points[i])) for c, own in picked.items() for i in own)
    got = {r.uid: r for r in M.assign_exemplar(df.where("cluster = -1"), chosen).collect()}
    for i in (50, 51, 52):                          # noise rows go to the nearest exemplar's cluster
        far, cluster = min((float(np.linalg.norm(points[i] - points[j])), c) for c, own in picked.items() for j in own)
        assert got[i].cluster == cluster and abs(got[i].distance - far) < 1e-9
    assert M.assign_exemplar(df, chosen.limit(0)).where("cluster IS NOT NULL").count() == 0
