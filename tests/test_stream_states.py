"""The burst rule by kept state equals the batch rule, however events arrive."""

import datetime as dt
import itertools
import random
import uuid

from pyspark.sql import functions as F

from bidscope.operators import flags as FL
from bidscope.session import scratch_path
from bidscope.sources.tables import read_table
from bidscope.streaming import states as ST
from bidscope.streaming.bursts import EVENT_SCHEMA

SF = "/root/testdata/sf0.001"
K, DAYS = 3, 7


def test_first_burst_against_all_choices():
    rng = random.Random(5)
    for _ in range(300):
        days = sorted(rng.randrange(25) for _ in range(rng.randrange(0, 9)))
        k, span = rng.randrange(1, 5), rng.randrange(0, 6)
        want = min((c[0] for c in itertools.combinations(days, k) if c[-1] - c[0] <= span), default=None)
        assert ST.first_burst({d: min(k, days.count(d)) for d in days}, k, span) == want


def run(spark, source, watermark, files=None, base=None):
    base = base or scratch_path(spark, f"test_states/{uuid.uuid4().hex[:8]}")
    out = ST.follow_stream(spark, source, f"{base}/out", f"{base}/ckpt", K, DAYS, watermark, files)
    return sorted(map(tuple, out.collect()))


def test_stream_equals_the_batch_rule(spark):
    events = read_table(spark, SF, "events")
    days = FL.burst_days(events.withColumn("d", F.date_format("ts", "yyyy-MM-dd")), ST.KEYS, "d", DAYS, K)
    want = sorted(map(tuple, days.where("_start = 1").groupBy(*ST.KEYS).agg(F.min("_day")).collect()))
    assert want and run(spark, f"{SF}/events.parquet", "1 day") == want
    base = scratch_path(spark, f"test_states/{uuid.uuid4().hex[:8]}")
    for files in (1, 5):                       # shuffled rows: any event may come last
        events.orderBy(F.md5(F.col("event_id").cast("string"))).repartition(files).write.parquet(f"{base}/shuffled-{files}")
        assert run(spark, f"{base}/shuffled-{files}", "4000 days", 1) == want


def write(spark, path, rows):
    full = [(i, ts, user, kind, 0.0, None) for i, (ts, user, kind) in enumerate(rows)]
    spark.createDataFrame(full, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_goes_on_from_its_state_and_leaves_nulls_out(spark):
    base = scratch_path(spark, f"test_states/{uuid.uuid4().hex[:8]}")
    day = lambda n: dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=n)
    first = int(day(0).timestamp() // 86400)
    write(spark, f"{base}/in", [(day(0), 1, "a"), (day(5), 1, "a"), (day(0), 2, "a"), (day(0), 2, "a"), (day(0), 2, "a"),
                                (None, 1, "a"), (day(1), None, "a"), (day(1), 1, None), (day(0), 3, "a"), (day(1), 3, "a")])
    assert run(spark, f"{base}/in", "30 days", base=base) == [(2, "a", first)]
    # a third within the span of the two kept; one too late for it; an earlier start by late events
    write(spark, f"{base}/in", [(day(7), 1, "a"), (day(8), 3, "a"), (day(-2), 2, "a"), (day(-2), 2, "a")])
    assert run(spark, f"{base}/in", "30 days", base=base) == [(1, "a", first), (2, "a", first - 2)]


def test_forgets_what_the_watermark_left_and_still_agrees(spark):
    events = read_table(spark, SF, "events")
    base = scratch_path(spark, f"test_states/{uuid.uuid4().hex[:8]}")
    ends = [r[0] for r in events.agg(F.percentile_approx("ts", [0.3, 0.6]).alias("q")).select(F.explode("q")).collect()]
    parts = [events.where(F.col("ts") < ends[0]), events.where((F.col("ts") >= ends[0]) & (F.col("ts") < ends[1])), events.where(F.col("ts") >= ends[1])]
    got = None
    for part in parts:                         # in order of time, the state carried over
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        got = run(spark, f"{base}/in", "1 day", base=base)
    assert got == run(spark, f"{SF}/events.parquet", "1 day")
    events.limit(0).write.parquet(f"{base}/empty")
    assert run(spark, f"{base}/empty", "1 day") == []
