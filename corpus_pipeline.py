"""The training-data pipeline over ``documents``.

Four stages, each reading what its predecessor wrote: documents of low
quality go, of each group of near copies one stays, documents that hold test
passages go, and the rest is encoded.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm import bpe, fmindex, jaccard, quality
from bidscope.llm.columns import known_small
from bidscope.session import FAT_ROWS, scratch_path, stage, tune


#: Of an Arrow batch: whole texts are long, and several stages share an executor's memory.
LEAN = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
        "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", str(8 << 20))}


def lean(spark: SparkSession) -> SparkSession:
    """Smaller Arrow batches, unless the session asks for other than Spark's."""
    for name, (usual, small) in LEAN.items():
        if spark.conf.get(name, None) == usual:
            spark.conf.set(name, small)
    return spark


def free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, learned from this stage's own
    documents and the labels."""
    model = quality.fit(docs, lean(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    own = {c: free(docs, f"_{c}") for c in ("score", "predicted")}
    kept = quality.score(docs.withColumnsRenamed(own), model).where("predicted = 1")
    return kept.drop(*own).withColumnsRenamed({v: k for k, v in own.items()}).select(docs.columns)


def row_identity(docs: DataFrame) -> Column:
    """What sets a row apart from all that differ in any column; in order of
    doc_id, null ones last."""
    columns = [F.col(c) for c in docs.columns]
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.unhex(F.md5("text")).alias("text"),
                    F.xxhash64(*[c.isNull() for c in columns], *columns).alias("row"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by four fifths of their five-word shingles, the
    one with the smallest doc_id; of rows that are wholly equal, one.  Rows
    are told apart by all their columns: a doc_id may be null or repeat."""
    lean(spark)
    if not docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        docs = stage(docs.dropDuplicates(), "distinct")
    own = row_identity(docs)
    found = jaccard.components(docs.select(own.alias("row"), "text"), key="row")
    mine, other = free(docs, "_own"), free(docs, "_other")
    others = found.where(~F.col("row").eqNullSafe(F.col("component_id"))).select(F.col("row").alias(other))
    others = known_small(stage(others, "others"))
    return docs.withColumn(mine, own).join(others, F.col(mine).eqNullSafe(F.col(other)), "left_anti").drop(mine)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row of a benchmark item."""
    lean(spark)
    texts = docs.select(F.md5("text").alias("doc_id"), "text")
    index = stage(fmindex.build_index(texts, shard_bytes=1 << 19), "fm-index", **FAT_ROWS)
    hit = fmindex.contamination(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated")
    name = free(docs, "_hit")
    hit = known_small(stage(hit.select(F.col("doc_id").alias(name)).distinct(), "hit"))
    return docs.join(hit, F.md5("text") == F.col(name), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, counts and digests of every document that is left."""
    lean(spark)
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                keep=["doc_id", "lang", "source", "n_chars"], remembered=30_000, slice_bytes=2 << 20)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE encoding and decoding", encode),
]

#: A trained classifier and a tokenizer: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    own = uuid.uuid4().hex[:12]
    before = {name: spark.conf.get(name, None) for name in LEAN}
    try:
        for number, (_, apply) in enumerate(STAGES):
            path = scratch_path(spark, f"pipeline/{own}/{number}")
            apply(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        for name, value in before.items():
            if value is not None:
                spark.conf.set(name, value)
    return docs
