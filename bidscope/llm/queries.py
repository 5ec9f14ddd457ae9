"""The registered queries of this subpackage, with production parameters.

Each reads its whole table and returns its operator's full result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm import bpe, fmindex, jaccard, katz, pagediff, prefixtrie, quality, repair, rotation, shards, spotsigs, toxicity, warc
from bidscope.session import FAT_ROWS, scratch_path, stage, tune

Query = Callable[[SparkSession, str], DataFrame]

CRAWLED = "2024-01-01T00:00:00Z"        # the pages table has no dates

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


@query
def op2_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shuffled into 24 shards of equal row counts."""
    path = scratch_path(spark, f"shards/{uuid.uuid4().hex[:12]}")
    written = shards.shuffle_into(table(spark, sf_dir, "documents"), path, 24)
    return written.select("doc_id", "size", F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
                          F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and the conversion record of every page."""
    return warc.derive(warc.responses(table(spark, sf_dir, "pages"), CRAWLED))


@query
def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN, keep=["doc_id"], with_ids=False)


@query
def op8_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labelled rows."""
    return quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document is in the benchmark: an index of all shards,
    searched for all benchmark windows."""
    index = stage(fmindex.build_index(table(spark, sf_dir, "documents")), "fm-index", **FAT_ROWS)
    return fmindex.contamination(index, table(spark, sf_dir, "benchmark")).drop("spans")


@query
def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under a model of six sevenths of them."""
    held_out = quality.fold(F.col("doc_id"), katz.FOLDS) == katz.HELD_OUT
    return katz.score(table(spark, sf_dir, "documents"), held_out)


@query
def op6_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pagediff.extract(table(spark, sf_dir, "pages"))


@query
def op7_t_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their shingles."""
    return jaccard.components(table(spark, sf_dir, "documents"))


@query
def op9_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant."""
    return rotation.rotate(table(spark, sf_dir, "conversations")).select(
        "conv_id", "perspective", "piece", "n_turns", "dialogue",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["begin"], s["end"])), " ").alias("mask"))


@query
def op11_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of every damaged conversation."""
    conversations = table(spark, sf_dir, "conversations")
    return repair.digest(conversations, *repair.repair(repair.damage(conversations)))


@query
def op12_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled rows."""
    return toxicity.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("spans")


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefixtrie.trie(*prefixtrie.rebuild(prefixtrie.number_turns(table(spark, sf_dir, "conversations"))))


ORACLES["op9_rotation"] = rotation.ORACLE
