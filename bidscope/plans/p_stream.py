"""stream_bursts: Structured Streaming over the events table, with its batch
twin as the SQL oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bidscope.plans.registry import plan
from bidscope.session import scratch_path
from bidscope.sources.tables import table_path
from bidscope.streaming import bursts as B
from bidscope.streaming import states as ST

K = 5
DAYS = 7


@plan("stream_bursts", f"""
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, user_id, event_type, count(*) AS n_events FROM (
  SELECT user_id, event_type, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS ws
  FROM events, range(0, 7) r(k)) t
GROUP BY 1, 2, 3 HAVING count(*) >= {K}""", "2.13")
def stream_bursts(spark, sf):
    # a fresh output/checkpoint pair in the shared folder for each run
    base = scratch_path(spark, f"stream_bursts/{uuid.uuid4().hex[:12]}")
    return B.run_stream(spark, table_path(sf, "events"), f"{base}/out", f"{base}/checkpoint", K)


@plan("stream_bursts_state", f"""
SELECT user_id, event_type, strftime(min(d), '%Y-%m-%d') AS first_day FROM (
  SELECT user_id, event_type, d, lead(d, {K - 1}) OVER (PARTITION BY user_id, event_type ORDER BY d) AS last FROM (
    SELECT user_id, event_type, CAST(ts AS DATE) AS d FROM events
    WHERE ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL) a) b
WHERE last - d <= {DAYS} GROUP BY 1, 2""", "2.13")
def stream_bursts_state(spark, sf):
    """``K`` events whose dates span at most ``DAYS`` days, wherever they start."""
    base = scratch_path(spark, f"stream_bursts_state/{uuid.uuid4().hex[:12]}")
    found = ST.follow_stream(spark, table_path(sf, "events"), f"{base}/out", f"{base}/checkpoint", K, DAYS, "1 day")
    return found.select("user_id", "event_type", F.date_format(F.date_from_unix_date("first_day"), "yyyy-MM-dd").alias("first_day"))
