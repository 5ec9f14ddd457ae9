"""Two-pass external shuffle into training shards.

The first pass scatters records over buckets by a seeded hash; a bucket is so
small that a task holds it.  The second pass shuffles each bucket by Fisher and
Yates and writes it.  The buckets one after the other are a uniform shuffle of
the table, which is then cut into shards whose row counts differ by one at
most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.llm.columns import require
from bidscope.session import stage

BUCKET_BYTES = 24 << 20       # of records in a bucket, about
RECORD = 8                    # bytes of a record besides its text


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform order of n records: the last place gets one of all, the one
    before it one of the rest, and so on."""
    rng = np.random.Generator(np.random.PCG64([seed, bucket]))
    drawn = rng.integers(0, np.arange(1, n + 1)).tolist()
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = drawn[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def shuffle_into(docs: DataFrame, path: str, shards: int, seed: int = 0, text: str = "text",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` shuffled to ``path`` and return it read back, with
    ``size`` (UTF-8 bytes of ``text`` plus 8; a null text has none), ``shard``
    and ``slot`` (from 0 in each shard).

    A record's bucket depends on the seed, its text and its place in the
    input, so repeated rows scatter like any others; the same files read in
    the same splits give the same shards.  Columns of ``docs`` with the names
    ``bucket``, ``place``, ``size``, ``shard`` and ``slot`` are replaced."""
    require(docs, text)
    docs = docs.drop("bucket", "place", "size", "shard", "slot")
    sized = docs.withColumn("size", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + RECORD)
    rows, total = sized.agg(F.count("*"), F.sum("size")).first()
    buckets = max(shards, (total or 0) // bucket_bytes + 1)
    schema = T.StructType([*sized.schema, T.StructField("bucket", T.LongType()), T.StructField("place", T.LongType())])

    def shuffle(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        arrived = np.argsort(table.column("place").to_numpy(), kind="stable")      # in whatever order tasks sent them
        order = arrived[fisher_yates(table.num_rows, seed, bucket)]
        out = table.drop_columns(["place"]).take(pa.array(order))
        return out.append_column("place", pa.array(np.arange(table.num_rows)))

    (sized.withColumn("place", F.monotonically_increasing_id())
     .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "place", text), F.lit(buckets)))
     .select(*sized.columns, "bucket", "place").groupBy("bucket").applyInArrow(shuffle, schema)
     .write.mode("overwrite").parquet(path))

    written = docs.sparkSession.read.schema(schema).parquet(path)
    # One row for each bucket, written so that the join knows its size and moves no record where it is small.
    before = stage(written.groupBy("bucket").agg(F.count("*").alias("n")).select(
        "bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("before")), "before")
    at = F.col("before") + F.col("place")
    shard = F.expr(f"(before + place) * {shards}L div {max(rows, 1)}L")
    first = F.expr(f"(shard * {max(rows, 1)}L + {shards - 1}L) div {shards}L")
    return (written.join(before, "bucket").withColumn("shard", shard.cast("int")).withColumn("slot", at - first)
            .select(*docs.columns, "size", "shard", "slot"))
