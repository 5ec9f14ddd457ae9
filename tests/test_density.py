"""Density clustering, components and projections on data with known answers."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from bidscope.operators import density as D
from bidscope.operators import graph as G
from bidscope.operators import models as M


def blobs(seed=1):
    rng = np.random.default_rng(seed)
    a = rng.normal((0, 0), 0.1, (120, 2))
    b = rng.normal((5, 5), 0.1, (60, 2))
    hot = np.tile([[-4.0, 3.0]], (200, 1))
    far = np.array([[20.0, 20.0], [-20.0, 7.0], [9.0, -9.0]])
    return np.concatenate([a, b, hot, far])


def plain(points, eps, least, side):
    """DBSCAN of the cells' centres, weighted by their counts."""
    cells = {}
    for i, p in enumerate(points):
        cells.setdefault(tuple(int(math.floor(x / side)) for x in p), []).append(i)
    far = lambda a, b: side * math.dist(a, b)
    near = {c: [o for o in cells if far(c, o) <= eps * (1 + 1e-9)] for c in cells}
    core = {c for c in cells if sum(len(cells[o]) for o in near[c]) >= least}
    label = {}
    for c in sorted(core):
        if c not in label:
            todo = [c]
            while todo:
                x = todo.pop()
                if x not in label:
                    label[x] = c
                    todo += [o for o in near[x] if o in core]
    for c in cells.keys() - core:
        reach = [o for o in near[c] if o in core]
        if reach:
            label[c] = label[min(reach, key=lambda o: (far(c, o), o))]
    groups = {}
    for c, members in cells.items():
        for i in members:
            groups.setdefault(label.get(c), set()).add(i)
    return groups


def groups_of(rows):
    out = {}
    for r in rows:
        out.setdefault(None if r.cluster < 0 else r.cluster, set()).add(int(r.uid))
    return out


def frame(spark, points):
    return spark.createDataFrame([(str(i), *map(float, p)) for i, p in enumerate(points)], "uid string, x double, y double")


@pytest.mark.parametrize("resolution", [1.0, 0.5])
def test_dbscan(spark, resolution):
    points = blobs()
    got = groups_of(D.dbscan(frame(spark, points), ["x", "y"], 0.3, 5, resolution=resolution).collect())
    want = plain(points, 0.3, 5, 0.3 * resolution / math.sqrt(2))
    assert got.get(None) == want.get(None) and sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert got[0] == set(range(180, 380))            # the largest: one cell with most points
    assert {380, 381, 382} <= got[None]


def test_bridge_and_nulls(spark):
    points = [(x / 10, 0.0) for x in range(60)]
    df = frame(spark, points).unionByName(spark.createDataFrame([("100", None, 1.0)], "uid string, x double, y double"))
    rows = D.dbscan(df, ["x", "y"], 0.3, 3).collect()
    assert {r.cluster for r in rows if r.uid != "100"} == {0} and [r.cluster for r in rows if r.uid == "100"] == [-1]
    cut = frame(spark, [p for p in points if not 2 < p[0] < 3])
    assert {r.cluster for r in D.dbscan(cut, ["x", "y"], 0.3, 3).collect()} == {0, 1}
    assert D.dbscan(df.limit(0), ["x", "y"], 0.3, 3).count() == 0
    with pytest.raises(ValueError):
        D.dbscan(df, ["x", "y", "x", "y"], 0.3, 3)


def test_density_cluster_and_counts(spark):
    points = blobs()
    out = D.density_cluster(frame(spark, points), ["x", "y"], 70, 5, 0.3)
    got = groups_of(out.collect())
    assert sorted(len(v) for k, v in got.items() if k is not None) == sorted([200, len([i for i in got[1]])])
    assert set(range(120, 180)) <= got[None]         # too few for a cluster
    c = D.cluster_counts(out).first()
    assert (c.n_clusters, c.n_clustered + c.n_noise) == (2, len(points)) and c.noise_share == pytest.approx(len(got[None]) / len(points))


def test_connected_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(300, 360)]
    got = {r.node: r.label for r in G.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert got == {x: find(x) for x in parent}


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5)) + 7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "uid long, f array<double>").withColumn("features", array_to_vector("f"))
    model = M.fit_pca(df, 0.9)
    value, vector = np.linalg.eigh(np.cov(x.T))
    share = value[::-1] / value.sum()
    k = int(np.searchsorted(np.cumsum(share), 0.9)) + 1
    assert model.components.shape == (5, k) and np.allclose(model.explained, share[:k])
    for j in range(k):
        assert abs(abs(model.components[:, j] @ vector[:, ::-1][:, j]) - 1) < 1e-6
    got = {r.uid: r.p for r in M.pca_reduce(df, model).select("uid", vector_to_array("pca").alias("p")).collect()}
    err = {r.uid: r.recon_error for r in M.reconstruction_error(df, model).collect()}
    for i in range(200):
        z = (x[i] - x.mean(0)) @ model.components
        assert np.allclose(got[i], z) and err[i] == pytest.approx((((x[i] - x.mean(0)) - z @ model.components.T) ** 2).mean())


def test_assign_cluster(spark):
    cents = spark.createDataFrame([(0, [0.0, 0.0]), (1, [4.0, 0.0]), (2, [0.0, 4.0])], "cluster int, centroid array<double>")
    new = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("c", [0.0, 9.0])], "uid string, p array<double>").withColumn("pca", array_to_vector("p"))
    got = {r.uid: r for r in M.assign_cluster(new, cents).collect()}
    for uid, p in (("a", (1, 0)), ("b", (2, 0)), ("c", (0, 9))):
        d = [math.dist(p, c) ** 2 for c in ((0, 0), (4, 0), (0, 4))]
        assert got[uid].cluster == d.index(min(d)) and got[uid].distance == pytest.approx(min(d))
        assert got[uid].probability == pytest.approx(math.exp(-min(d) / 2) / sum(math.exp(-x / 2) for x in d))


def test_offsets_cover_the_radius():
    for d, r in itertools.product((1, 2, 3), (1.0, 0.5)):
        side = D._side(1.0, d, r)
        assert all(far <= 1.0 + 1e-6 for _, far in D._offsets(d, side, 1.0)) and len(D._offsets(d, side, 1.0)) <= (2 * int(1 / side + 1) + 1) ** d
