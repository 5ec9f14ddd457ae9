"""§2.13 retrieval plans: run_sql, chunk_documents, tfidf, knn_topk, vector_topk."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bidscope.functions.columns import md5_key
from bidscope.operators import clean as C
from bidscope.operators import models as M
from bidscope.operators import retrieve as RT
from bidscope.operators import vectorindex as VI
from bidscope.plans.oracle import md5_sql, with_contracts
from bidscope.plans.registry import plan
from bidscope.session import scratch_path
from bidscope.sources.tables import contracts, read_table

QUESTION_SQL = ("SELECT procedure, count(*) AS n_contracts, round(avg(montant), 2) AS avg_amount "
                "FROM contracts GROUP BY procedure ORDER BY n_contracts DESC, procedure")


@plan("run_sql", with_contracts(QUESTION_SQL + " LIMIT 3"), "2.13")
def run_sql(spark, sf):
    contracts(spark, sf).createOrReplaceTempView("contracts")
    try:
        return RT.run_sql(spark, QUESTION_SQL, top_k=3)
    finally:
        spark.catalog.dropTempView("contracts")       # the plan has what it named


@plan("chunk_documents", """
SELECT doc_id, CAST(k AS INTEGER) AS chunk_index, CAST(k * 450 AS INTEGER) AS chunk_start,
       CAST(length(substr(text, k * 450 + 1, 500)) AS INTEGER) AS chunk_len, md5(substr(text, k * 450 + 1, 500)) AS chunk_md5
FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / 450.0) AS BIGINT))) AS k FROM documents
      WHERE length(text) > 0) t""", "2.13")
def chunk_documents(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    ch = RT.chunk_documents(docs, 500, 50)
    return ch.select("doc_id", "chunk_index", "chunk_start", F.length("chunk").alias("chunk_len"),
                     F.md5("chunk").alias("chunk_md5"))


TOK_SQL = """tok AS (SELECT doc_id, term FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))
               AS term FROM documents) t),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY 1, 2),
  st AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY 1),
  voc AS (SELECT term, df FROM st ORDER BY total DESC, term LIMIT 5000),
  nd AS (SELECT count(*) AS n FROM documents),
  w AS (SELECT tf.doc_id, tf.term, tf.tf, voc.df, tf.tf * ln((CAST(nd.n AS DOUBLE) + 1) / (CAST(voc.df AS DOUBLE) + 1)) AS tfidf
        FROM tf JOIN voc USING (term), nd)"""


@plan("tfidf", """WITH """ + TOK_SQL + """
SELECT doc_id, term, tf, df, round(tfidf, 6) AS tfidf FROM w""", "2.13")
def tfidf(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return RT.tfidf(docs, 5000).select("doc_id", "term", "tf", "df", F.round("tfidf", 6).alias("tfidf"))


@plan("tfidf_top_terms", """WITH """ + TOK_SQL + """
SELECT doc_id, term, round(tfidf, 6) AS tfidf, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank FROM w) r WHERE rank <= 5""",
      "2.13")
def tfidf_top_terms(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    top = RT.top_terms(RT.tfidf(docs, 5000), 5)
    return top.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"), "rank")


KNN_Q = f"""q AS (SELECT uid AS query_id, montant / 1000000.0 AS q1, coalesce(dureeMois, 0) AS q2,
               coalesce(offresRecues, 0) AS q3 FROM contracts ORDER BY {md5_sql('uid', seed=7)}, uid LIMIT 5),
  p AS (SELECT uid, montant / 1000000.0 AS x1, coalesce(dureeMois, 0) AS x2, coalesce(offresRecues, 0) AS x3
        FROM contracts WHERE montant IS NOT NULL)"""


@plan("knn_topk", with_contracts("""
SELECT query_id, uid, round(distance, 9) AS distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT q.query_id, p.uid, (p.x1 - q.q1) * (p.x1 - q.q1) + (p.x2 - q.q2) * (p.x2 - q.q2)
         + (p.x3 - q.q3) * (p.x3 - q.q3) AS distance,
         row_number() OVER (PARTITION BY q.query_id ORDER BY (p.x1 - q.q1) * (p.x1 - q.q1) + (p.x2 - q.q2) * (p.x2 - q.q2)
         + (p.x3 - q.q3) * (p.x3 - q.q3), p.uid) AS rank
  FROM p, q WHERE p.uid <> q.query_id) t WHERE rank <= 10""", KNN_Q), "2.13")
def knn_topk(spark, sf):
    """10 nearest contracts (amount in millions, duration, bids) for each of
    5 sampled query contracts; the query sample is the bounded side."""
    c = contracts(spark, sf)
    feats = lambda pre: [(F.col("montant") / F.lit(1000000.0)).alias(f"{pre}1"),
                         F.coalesce("dureeMois", F.lit(0.0)).alias(f"{pre}2"),
                         F.coalesce("offresRecues", F.lit(0.0)).alias(f"{pre}3")]
    q = C.sample_rows(c, 5, 7).select(F.col("uid").alias("query_id"), *feats("q"))
    p = c.filter(F.col("montant").isNotNull()).select("uid", *feats("x"))
    d = RT.sq_l2([(F.col(f"x{i}"), F.col(f"q{i}")) for i in (1, 2, 3)])
    out = RT.knn_topk(p, q, 10, d, "uid", "query_id")
    return out.select("query_id", "uid", F.round("distance", 9).alias("distance"), "rank")


@plan("vector_topk", """
WITH e AS (SELECT vec_id, label, CAST(v AS DOUBLE) AS v, i FROM (
             SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) a),
c AS (SELECT label, i, avg(v) AS c FROM e GROUP BY 1, 2),
cn AS (SELECT label, sqrt(sum(c * c)) AS n FROM c GROUP BY 1),
en AS (SELECT vec_id, sqrt(sum(v * v)) AS n FROM e GROUP BY 1),
dot AS (SELECT c.label AS query_id, e.vec_id, sum(e.v * c.c) AS d FROM e JOIN c ON e.i = c.i GROUP BY 1, 2),
s AS (SELECT dot.query_id, dot.vec_id, dot.d / (en.n * cn.n) AS sim FROM dot JOIN en USING (vec_id)
      JOIN cn ON cn.label = dot.query_id)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(sim, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY -sim, vec_id) AS rank FROM s) t WHERE rank <= 10""",
      "2.13")
def vector_topk(spark, sf):
    emb = read_table(spark, sf, "embeddings", ["vec_id", "label", "embedding"])
    q = RT.label_centroids(emb).withColumnRenamed("label", "query_id")     # one row per label
    out = RT.vector_topk(emb, q, 10)
    return out.select("query_id", "vec_id", "rank", F.round("similarity", 6).alias("similarity"))


def _search(spark, sf, probes):
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    path = scratch_path(spark, f"vector-index/{uuid.uuid4().hex[:12]}")
    VI.build(emb, path)
    asked = emb.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return VI.search(spark, path, asked, 10, probes).select(
        F.col("query").alias("query_id"), F.col("key").alias("vec_id"), "rank", F.round("similarity", 6).alias("similarity"))


@plan("vector_search", None, "2.13")
def vector_search(spark, sf):
    """The 10 most similar vectors of every twentieth one, from the lists of
    the stored index that are nearest to it."""
    return _search(spark, sf, 24)


@plan("vector_search_exact", """
WITH e AS (SELECT vec_id, CAST(v AS DOUBLE) AS v, i FROM (
             SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) a),
n AS (SELECT vec_id, sqrt(sum(v * v)) AS n FROM e GROUP BY 1),
u AS (SELECT e.vec_id, e.i, e.v / n.n AS v FROM e JOIN n USING (vec_id)),
s AS (SELECT q.vec_id AS query_id, p.vec_id, sum(q.v * p.v) AS sim FROM u q JOIN u p USING (i) WHERE q.vec_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(sim, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY -sim, vec_id) AS rank FROM s) t WHERE rank <= 10""", "2.13")
def vector_search_exact(spark, sf):
    """The same from all lists of the index."""
    return _search(spark, sf, None)


PLACE = "log10(greatest(montant, 1.0)) AS x1, ln(1 + coalesce(dureeMois, 0)) AS x2, CAST(coalesce(offresRecues, 0) AS DOUBLE) AS x3"


@plan("assign_exemplar", with_contracts("""
SELECT uid, arg_min(cluster, struct_pack(d := d, c := cluster)) AS cluster, round(sqrt(min(d)), 6) AS distance FROM (
  SELECT p.uid, ex.categorie AS cluster,
         (p.x1 - ex.x1) * (p.x1 - ex.x1) + (p.x2 - ex.x2) * (p.x2 - ex.x2) + (p.x3 - ex.x3) * (p.x3 - ex.x3) AS d
  FROM p, ex) t GROUP BY uid""", f"""p AS (SELECT uid, categorie, {PLACE} FROM contracts WHERE montant IS NOT NULL),
  ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY categorie ORDER BY {md5_sql('uid', seed=11)}, uid) AS r
         FROM p WHERE categorie IS NOT NULL) a WHERE r <= 10)"""), "2.13")
def assign_exemplar(spark, sf):
    """Every contract to the nearest of ten stated exemplars of each
    category (amount, duration, bids)."""
    rows = contracts(spark, sf).where("montant IS NOT NULL").select(
        "uid", F.col("categorie").alias("cluster"), F.array(
            F.log10(F.greatest("montant", F.lit(1.0))), F.log1p(F.coalesce("dureeMois", F.lit(0)).cast("double")),
            F.coalesce("offresRecues", F.lit(0)).cast("double")).alias("v"))
    out = M.assign_exemplar(rows, M.exemplars(rows, md5_key("uid", seed=11)))
    return out.select("uid", "cluster", F.round("distance", 6).alias("distance"))
