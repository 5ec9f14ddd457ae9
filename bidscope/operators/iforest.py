"""Isolation forest with Spark doing the data movement.

1. Sample: one pool of ``n_trees · max_samples`` rows, the rows with the
   smallest md5(uid:seed) (exact, distributed ``take_smallest``), dealt into
   disjoint per-tree samples by rank inside the pool (a bounded window).
2. Train: ``groupBy(tree_id).applyInPandas`` grows one isolation tree per
   group of ``max_samples`` rows (random feature, random split, depth limit
   ceil(log2 ψ)), emitting the tree as rows.
3. Score: the trees (≤ n_trees · (2ψ−1) nodes, a fixed bound) are collected
   once and broadcast; a pandas UDF walks all trees for each Arrow batch.
   score = 2^(−E[h(x)] / c(ψ)); the ``contamination`` share with the highest
   scores is flagged through the exact distributed percentile.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.columns import md5_key
from bidscope.operators.graph import threshold_flag
from bidscope.operators.quantiles import hash_rank_value, take_smallest

TREE_SCHEMA = ("tree_id int, node int, feature int, threshold double, left int, right int, size int")


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(pdf: pd.DataFrame, n_features: int, max_depth: int) -> pd.DataFrame:
    tree_id = int(pdf["tree_id"].iloc[0])
    x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, n_features))
    rng = np.random.default_rng(10_007 * tree_id + 1)
    rows = []

    def build(idx: np.ndarray, depth: int) -> int:
        node = len(rows)
        rows.append(None)
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            rows[node] = (tree_id, node, -1, 0.0, -1, -1, int(len(idx)))
            return node
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            rows[node] = (tree_id, node, -1, 0.0, -1, -1, int(len(idx)))
            return node
        f = int(rng.choice(cand))
        thr = float(rng.uniform(lo[f], hi[f]))
        left = build(idx[sub[:, f] < thr], depth + 1)
        right = build(idx[sub[:, f] >= thr], depth + 1)
        rows[node] = (tree_id, node, f, thr, left, right, int(len(idx)))
        return node

    build(np.arange(len(x)), 0)
    return pd.DataFrame(rows, columns=["tree_id", "node", "feature", "threshold", "left", "right", "size"])


def fit(df: DataFrame, features: Sequence[str], n_trees: int = 100, max_samples: int = 256,
        seed: int = 42, key: str = "uid") -> pd.DataFrame:
    vec = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    h = df.select(key, vec.alias("x"), hash_rank_value(md5_key(key, seed=seed)).alias("_h"))
    pool = take_smallest(h, "_h", F.lit(n_trees * max_samples), hashes=True)          # exact, bounded pool
    ranked = pool.withColumn("_r", F.row_number().over(Window.orderBy("_h")) - 1)   # ≤ n_trees·ψ rows
    samples = ranked.select((F.col("_r") % n_trees).cast("int").alias("tree_id"), "x")
    depth = int(math.ceil(math.log2(max(max_samples, 2))))
    nf = len(features)
    trees = samples.groupBy("tree_id").applyInPandas(lambda p: _grow(p, nf, depth), TREE_SCHEMA)
    return trees.toPandas()   # ≤ n_trees · (2ψ − 1) rows: a fixed bound


def score(df: DataFrame, trees: pd.DataFrame, features: Sequence[str], key: str = "uid") -> DataFrame:
    spark = df.sparkSession
    packed = {}
    for t, g in trees.groupby("tree_id"):
        g = g.sort_values("node")
        leaf_adj = np.array([(_c(s) if f < 0 else 0.0) for f, s in zip(g["feature"], g["size"])])
        packed[int(t)] = (g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                          g["right"].to_numpy(), leaf_adj)
    b = spark.sparkContext.broadcast(packed)
    # trees of a small table hold fewer than max_samples rows: what each really had
    cpsi = max(float(np.mean([_c(n) for n in trees.loc[trees["node"] == 0, "size"]])), 1e-12)

    @F.pandas_udf(T.DoubleType())
    def _score(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy())
        total = np.zeros(len(x))
        for feat, thr, left, right, adj in b.value.values():
            node = np.zeros(len(x), dtype=np.int64)
            depth = np.zeros(len(x))
            active = feat[node] >= 0
            while active.any():
                f = feat[node[active]]
                go_left = x[active, f] < thr[node[active]]
                node[active] = np.where(go_left, left[node[active]], right[node[active]])
                depth[active] += 1
                active = feat[node] >= 0
            total += depth + adj[node]
        return pd.Series(np.power(2.0, -(total / len(b.value)) / cpsi))

    vec = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    return df.withColumn("anomaly_score", _score(vec))


def isolation_forest(df: DataFrame, features: Sequence[str], contamination: float = 0.005, n_trees: int = 100,
                     max_samples: int = 256, seed: int = 42, key: str = "uid") -> DataFrame:
    """(key, anomaly_score, is_anomaly, prediction) with prediction −1 for
    anomalies and 1 otherwise."""
    trees = fit(df, features, n_trees, max_samples, seed, key)
    s = score(df.select(key, *features), trees, features, key)
    flagged = threshold_flag(s, "anomaly_score", contamination * 100.0)
    return flagged.select(key, "anomaly_score", "is_anomaly",
                          F.when(F.col("is_anomaly"), F.lit(-1)).otherwise(F.lit(1)).alias("prediction"))
