"""Retrieval: SQL execution, document chunking, TF-IDF,
exact nearest neighbours for a bounded query set.

Nearest neighbours never pair the table with itself: queries are a stated
set (sampled contracts, per-label centroids), sent to the tasks in blocks of
a bounded number of rows; each task keeps k points of a query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidscope.functions.columns import dbl
from bidscope.session import stage_small as stage

QUERY_ROWS = 10_000           # of a query set that go to the tasks at once


def _reads_only(spark: SparkSession, text: str) -> bool:
    """Whether the parsed statement has no command and no write in it."""
    jvm = spark._jvm
    kinds = [jvm.java.lang.Class.forName(f"org.apache.spark.sql.catalyst.plans.logical.{k}") for k in ("Command", "ParsedStatement")]

    def reads(node) -> bool:
        below = [node.children().apply(i) for i in range(node.children().size())]
        return not any(k.isInstance(node) for k in kinds) and all(map(reads, below))
    return reads(spark._jsparkSession.sessionState().sqlParser().parsePlan(text))


def run_sql(spark: SparkSession, text: str, top_k: int = 10) -> DataFrame:
    """Execute a statement that only reads, as its parsed plan says (which
    needs a session in this process, not one over Spark Connect), capped
    at ``top_k`` rows (the cap is the feature: an answer preview).  Errors
    propagate as exceptions."""
    if not _reads_only(spark, text):
        raise ValueError("only statements that read are allowed")
    return spark.sql(text).limit(top_k)


def quote_table(name: str) -> str:
    """Back-tick a table name that contains dots (e.g. data.gouv.fr.2022.clean)."""
    return f"`{name}`" if "." in name and not name.startswith("`") else name


def chunk_documents(docs: DataFrame, size: int = 500, overlap: int = 50, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """Fixed-size character chunks with overlap over whole texts:
    starts 0, size−overlap, 2(size−overlap), …  (one row per chunk)."""
    step = size - overlap
    n = F.length(text)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array())
    ex = docs.select(key, text, F.posexplode(starts).alias("chunk_index", "chunk_start"))
    return ex.select(key, "chunk_index", "chunk_start",
                     F.expr(f"substring({text}, chunk_start + 1, {size})").alias("chunk"))


def tokens(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc, term): lower-case runs of letters and digits of any script."""
    toks = F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")
    return docs.select(key, F.explode(toks).alias("term")).filter(F.length("term") > 0)


def tfidf(docs: DataFrame, vocab_size: int = 5000, text: str = "text", key: str = "doc_id") -> DataFrame:
    """tf · ln((N+1)/(df+1)) over the ``vocab_size`` most frequent terms
    (ties by term), as (doc, term, tf, df, tfidf).  The vocabulary is a
    top-k report over the per-term aggregate."""
    t = tokens(docs, text, key)
    tf = t.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    stats = tf.groupBy("term").agg(F.sum("tf").alias("_total"), F.count(F.lit(1)).alias("df"))
    vocab = stats.orderBy(F.desc("_total"), "term").limit(vocab_size).select("term", "df")
    n_docs = docs.agg(F.count(F.lit(1)).alias("_N"))
    j = tf.join(F.broadcast(vocab), "term").crossJoin(F.broadcast(n_docs))   # vocab ≤ vocab_size rows
    idf = F.log((F.col("_N") + dbl(1)) / (F.col("df") + dbl(1)))
    return j.select(key, "term", "tf", "df", (F.col("tf") * idf).alias("tfidf"))


def top_terms(tfidf_df: DataFrame, k: int = 5, key: str = "doc_id") -> DataFrame:
    """k highest-weighted terms per document (ties by term)."""
    w = Window.partitionBy(key).orderBy(F.desc("tfidf"), "term")
    return tfidf_df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_topk(points: DataFrame, queries: DataFrame, k: int, dist: Column, key: str = "uid",
             qkey: str = "query_id", exclude_self: bool = True) -> DataFrame:
    """Exact k nearest points per query; ``dist`` is a column expression over
    point and query columns, ties are broken by the point key.  Each block of
    ``QUERY_ROWS`` queries, about, is broadcast; a task keeps k points of a
    query (``WindowGroupLimit``) before the shuffle."""
    queries = stage(queries, "queries")
    blocks = -(-max(queries.count(), 1) // QUERY_ROWS)
    w = Window.partitionBy(qkey).orderBy("distance", key)
    found = None
    for b in range(blocks):
        some = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64(qkey), F.lit(blocks)) == b)
        j = points.crossJoin(F.broadcast(some)).withColumn("distance", dist)
        if exclude_self:
            j = j.filter(F.col(key) != F.col(qkey))
        top = j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        found = top if found is None else found.unionByName(top)
    return found


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), dbl(0), lambda acc, v: acc + v)
    na = F.sqrt(F.aggregate(a, dbl(0), lambda acc, v: acc + v * v))
    nb = F.sqrt(F.aggregate(b, dbl(0), lambda acc, v: acc + v * v))
    return dot / (na * nb)


def label_centroids(emb: DataFrame, vec: str = "embedding", label: str = "label") -> DataFrame:
    """Mean vector per label (exploded per dimension; one row per label)."""
    e = emb.select(label, F.posexplode(vec).alias("i", "v"))
    c = e.groupBy(label, "i").agg(F.avg(F.col("v").cast("double")).alias("c"))
    return c.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("i", "c"))).alias("_cs")) \
            .select(label, F.transform("_cs", lambda s: s["c"]).alias("centroid"))


def vector_topk(emb: DataFrame, queries: DataFrame, k: int = 10, vec: str = "embedding",
                key: str = "vec_id", qkey: str = "query_id", qvec: str = "centroid") -> DataFrame:
    """k most cosine-similar vectors per query vector."""
    x = emb.select(key, F.transform(vec, lambda v: v.cast("double")).alias("_v"))
    sim = cosine(F.col("_v"), F.col(qvec))
    out = knn_topk(x, queries, k, -sim, key, qkey, exclude_self=False)
    return out.select(qkey, key, "rank", (-F.col("distance")).alias("similarity"))


def sq_l2(cols: Sequence[tuple[Column, Column]]) -> Column:
    out = dbl(0)
    for a, b in cols:
        out = out + (a - b) * (a - b)
    return out
