"""A stored index of vectors: coarse centroids and lists.

Centroids are fitted on a bounded sample; every row is in the list of its
nearest centroid, written as Parquet partitioned by list, unit vectors at
full precision.  A list of very many rows is in several parts, each searched
in a task of its own, and so are very many queries of one list.  A search
reads the lists of the ``probes`` nearest centroids of each query and scores
their rows exactly; with all lists it is the exact search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidscope.functions.columns import dbl
from bidscope.session import stage_small as stage

SAMPLE = 50_000               # rows that the centroids are fitted on, at most
LISTS = 1024                  # at most
PART = 20_000                 # rows of a list, or queries of it, that one task holds
STEP = 1 << 22                # scores in memory at once


def _unit(vector: str):
    size = F.sqrt(F.aggregate(vector, dbl(0), lambda acc, v: acc + v * v))
    return F.transform(vector, lambda v: v / size)


def _clean(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    """(name, v): unit vectors; rows with a null, NaN or zero vector have no
    direction and are left out."""
    x = df.select(F.col(key).alias(name), F.transform(vector, lambda v: v.cast("double")).alias("v"))
    bad = F.exists("v", lambda v: v.isNull() | F.isnan(v)) | ~F.exists("v", lambda v: v != 0)
    return x.where(F.col("v").isNotNull() & ~bad).select(name, _unit("v").alias("v"))


def build(df: DataFrame, path: str, key: str = "vec_id", vector: str = "embedding", lists: int | None = None, seed: int = 7) -> None:
    """Write the index of ``df`` to ``path``: every row with a direction."""
    rows = stage(_clean(df, key, vector, "key"), "vectors")
    n = rows.count()
    k = lists or max(1, min(LISTS, math.isqrt(n)))
    sample = rows.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select(array_to_vector("v").alias("features"))
    centres = np.array(KMeans(k=k, seed=seed, maxIter=10).fit(sample).clusterCenters()) if n else np.zeros((1, 1))
    shared = df.sparkSession.sparkContext.broadcast(centres)          # at most LISTS rows

    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        c = shared.value
        x = np.stack(v.to_numpy()) if len(v) else np.empty((0, c.shape[1]))
        return pd.Series(((c ** 2).sum(1) - 2 * x @ c.T).argmin(1).astype(np.int32))
    listed = stage(rows.withColumn("list", nearest("v")), "listed")
    parts = listed.groupBy("list").agg(F.ceil(F.count("*") / PART).alias("parts"))          # a row a list
    dealt = listed.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int"))
    dealt.drop("parts").repartition("list", "part").write.partitionBy("list").parquet(f"{path}/lists")
    df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "list int, centre array<double>").write.parquet(f"{path}/centroids")


def _score(k: int):
    """The ``k`` rows of a part that are most alike to each of its queries;
    of equal ones the smaller keys."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = [pa.field("query", queries.schema.field("query").type), pa.field("key", rows.schema.field("key").type), pa.field("similarity", pa.float64())]
        if not rows.num_rows or not queries.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in names})
        rows = rows.sort_by("key")
        x, q = (np.stack(t.column("v").to_numpy()) for t in (rows, queries))
        step, best, found = max(1, STEP // len(x)), [], []
        for at in range(0, len(q), step):
            alike = q[at:at + step] @ x.T
            top = np.argsort(-alike, axis=1, kind="stable")[:, :k]
            best.append(top)
            found.append(np.take_along_axis(alike, top, 1))
        best, found = np.concatenate(best), np.concatenate(found)
        return pa.table([queries.column("query").take(pa.array(np.repeat(np.arange(len(q)), best.shape[1]))),
                         rows.column("key").take(pa.array(best.ravel())), pa.array(found.ravel())], schema=pa.schema(names))
    return run


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, probes: int | None = 8,
           key: str = "query_id", vector: str = "embedding") -> DataFrame:
    """(query, key, similarity, rank): for each query its ``k`` most
    cosine-similar rows in the lists of its ``probes`` nearest centroids; in
    all lists, so exactly, if ``probes`` is None.  Ties go to the smaller key;
    queries without a direction have no rows."""
    lists, table = spark.read.parquet(f"{path}/lists"), spark.read.parquet(f"{path}/centroids")
    centres = np.array([r.centre for r in table.orderBy("list").collect()])
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("array<int>")
    def near(v: pd.Series) -> pd.Series:
        c = shared.value
        x = np.stack(v.to_numpy()) if len(v) else np.empty((0, c.shape[1]))
        order = np.argsort((c ** 2).sum(1) - 2 * x @ c.T, axis=1, kind="stable")
        return pd.Series(list(order[:, :probes].astype(np.int32)))
    asked = _clean(queries, key, vector, "query")
    asked = stage(asked.withColumn("list", F.explode(near("v"))), "asked")
    parts = stage(lists.select("list", "part").distinct(), "parts")                         # a row a part
    blocks = stage(asked.groupBy("list").agg(F.ceil(F.count("*") / PART).alias("blocks")), "blocks")
    tasks = stage(parts.join(blocks, "list").select("list", "part", "blocks"), "tasks")
    some = asked.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("query"), "blocks")).drop("blocks").join(
        F.broadcast(parts), "list")
    every = lists.join(F.broadcast(tasks), ["list", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    group = ["list", "part", "block"]
    schema = f"query {asked.schema['query'].dataType.simpleString()}, key {lists.schema['key'].dataType.simpleString()}, similarity double"
    found = every.groupBy(*group).cogroup(some.groupBy(*group)).applyInArrow(_score(k), schema)
    best = Window.partitionBy("query").orderBy(F.desc("similarity"), "key")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
