"""Burst detection on the event stream (Structured Streaming).

Re-aim of the temporal-cluster rule for a stream: sliding event-time windows
(``window_len`` wide, ``slide`` apart) count events per (user, event type);
a window with at least ``k`` events is a burst.  A watermark bounds the
state; the query runs in update mode and every micro-batch upserts its
changed windows into a Parquet table in the shared folder through
``foreachBatch`` (the latest count of a window is its largest, since counts
only grow).  The checkpoint location lives in the shared folder too, so a
restarted driver resumes where it stopped.

Lateness: an event may come in a later micro-batch than events that are up to
``watermark`` younger and still counts; beyond that its windows are final.
All files that are there at the start make one micro-batch, in which nothing
is late, so how a table is split into files changes no count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def window_counts(events: DataFrame, window_len: str = "7 days", slide: str = "1 day",
                  watermark: str = "1 day") -> DataFrame:
    return (events.withWatermark("ts", watermark)
                  .groupBy(F.window("ts", window_len, slide), "user_id", "event_type")
                  .agg(F.count(F.lit(1)).alias("n_events")))


def bursts_batch(events: DataFrame, k: int, window_len: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Batch twin of the streaming query (same windows, same threshold)."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    c = events.groupBy(F.window("ts", window_len, slide), "user_id", "event_type") \
              .agg(F.count(F.lit(1)).alias("n_events"))
    return _shape(c.filter(F.col("n_events") >= k))


def _shape(df: DataFrame) -> DataFrame:
    return df.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                     "user_id", "event_type", "n_events")


def run_stream(spark: SparkSession, source: str, out_path: str, checkpoint: str, k: int,
               window_len: str = "7 days", slide: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Process what the table at ``source`` (a folder or one file) holds now,
    then stop; return the bursts."""
    # As a pattern that matches only itself: a stream takes a plain path for a folder.
    exactly = f"{source.rstrip('/')[:-1]}[{source.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(exactly)
    # event time must be a session-zone TIMESTAMP for watermarks
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    counts = window_counts(stream, window_len, slide, watermark)

    def upsert(batch: DataFrame, epoch: int) -> None:
        # append this batch's updated windows, tagged with the epoch; readers
        # keep the largest count per window (a replayed epoch rewrites the
        # same rows, so the table stays idempotent under retries)
        (batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite")
              .parquet(f"{out_path}/epoch={epoch}"))

    q = (counts.writeStream.outputMode("update").foreachBatch(upsert)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    latest = spark.read.parquet(out_path).groupBy("window", "user_id", "event_type") \
                  .agg(F.max("n_events").alias("n_events"))
    return _shape(latest.filter(F.col("n_events") >= k))
