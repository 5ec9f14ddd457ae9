"""The burst rule on a stream by kept state.

Where ``bursts.py`` counts in windows that start at fixed days, this follows
each (user, event type) and finds ``k`` events whose dates span at most
``days`` days wherever they start, the rule of ``flags.burst_groups``.  The
state of a group is its count of events per day, capped at ``k`` (more change
nothing), and the first day of the earliest burst found.  Days that the
watermark has left behind by more than ``days`` can be in no new burst and
are dropped; a group without newer events is forgotten by a timer.  So the
state of a group is bounded by the watermark and the rule, not by its events.

Counts per group and day are summed before the shuffle within each task, so a
group that holds a third of all events moves a row a day and Arrow batch.
Events without date, user or type are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bidscope.functions.columns import col_or
from bidscope.streaming.bursts import EVENT_SCHEMA

KEYS = ["user_id", "event_type"]
FOUND = "user_id long, event_type string, first_day int"
STATE = "first int, days array<int>, counts array<int>"
DAY_MS = 86_400_000


def first_burst(counts: dict[int, int], k: int, days: int) -> int | None:
    """The first day from which ``k`` events lie within ``days`` days."""
    order, total, end = sorted(counts), 0, 0
    for day in order:
        while end < len(order) and order[end] <= day + days:
            total += counts[order[end]]
            end += 1
        if total >= k:
            return day
        total -= counts[day]
    return None


def _sum_days(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.groupby([*KEYS, "ts"], as_index=False).size().rename(columns={"size": "n"})


def _follow(k: int, days: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, counts = None, {}
        if state.exists:
            first, order, kept = state.get
            counts = dict(zip(order, kept))
        for f in frames:
            for day, n in zip((f["ts"].astype("datetime64[ms]").astype("int64") // DAY_MS).tolist(), f["n"].tolist()):
                counts[day] = min(k, counts.get(day, 0) + n)
        found = first_burst(counts, k, days)
        earlier = found is not None and (first is None or found < first)
        if earlier:
            first = found
        newest, left = max(counts), state.getCurrentWatermarkMs() // DAY_MS - days
        order = sorted(day for day in counts if day >= left)
        state.update((first, order, [counts[day] for day in order]))
        state.setTimeoutTimestamp(max(newest + days + 1, left + days + 1) * DAY_MS)
        if earlier:
            yield pd.DataFrame({"user_id": [key[0]], "event_type": [key[1]], "first_day": [first]})
    return run


def burst_states(events: DataFrame, k: int, days: int, watermark: str) -> DataFrame:
    """(user_id, event_type, first_day) of a stream of events: a row when a
    group's first burst is found, and again if a late event makes it earlier."""
    known = events.where(F.col("ts").isNotNull() & F.col("user_id").isNotNull() & F.col("event_type").isNotNull())
    daily = known.select(*KEYS, F.date_trunc("day", col_or("ts")).cast("timestamp").alias("ts")) \
                 .mapInPandas(_sum_days, "user_id long, event_type string, ts timestamp, n long")
    return daily.withWatermark("ts", watermark).groupBy(*KEYS) \
                .applyInPandasWithState(_follow(k, days), FOUND, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def follow_stream(spark: SparkSession, source: str, out_path: str, checkpoint: str, k: int, days: int,
                  watermark: str, files_per_batch: int | None = None) -> DataFrame:
    """Process what the table at ``source`` holds now, then stop; return each
    group that has a burst, with the first day of the earliest one.  An event
    counts if it comes at most ``watermark`` behind the newest of earlier
    micro-batches.  The checkpoint keeps state and progress: called again with
    the same folders it goes on with new files.  A micro-batch that is run
    again overwrites its own folder, so nothing is there twice."""
    exactly = f"{source.rstrip('/')[:-1]}[{source.rstrip('/')[-1]}]"
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = burst_states(reader.parquet(exactly), k, days, watermark)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")
    spark.createDataFrame([], FOUND).write.mode("overwrite").parquet(f"{out_path}/epoch=-1")
    found.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint) \
         .trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(FOUND).parquet(out_path).groupBy(*KEYS).agg(F.min("first_day").alias("first_day"))
