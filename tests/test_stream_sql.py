"""Streaming burst query equals its batch twin; run_sql is read-only."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
def test_stream_equals_batch_twin(spark):
    from bidscope.session import scratch_path
    from bidscope.sources.tables import read_table
    from bidscope.streaming import bursts as B
    base = scratch_path(spark, f"test_stream/{uuid.uuid4().hex[:8]}")
    batch = B.bursts_batch(read_table(spark, SF, "events"), k=3)
    key = lambda r: (r.window_start, r.user_id, r.event_type, r.n_events)
    want = sorted(map(key, batch.collect()))
    sources = [f"{SF}/events.parquet"]
    for files in (1, 5):                       # shuffled rows, in a folder of part files
        sources.append(f"{base}/events-{files}")
        read_table(spark, SF, "events").orderBy(F.md5(F.col("event_id").cast("string"))).repartition(files).write.parquet(sources[-1])
    for i, source in enumerate(sources):
        streamed = B.run_stream(spark, source, f"{base}/out{i}", f"{base}/ckpt{i}", k=3)
        assert sorted(map(key, streamed.collect())) == want


def test_run_sql_rejects_writes(spark):
    from bidscope.operators.retrieve import quote_table, run_sql
    with pytest.raises(ValueError):
        run_sql(spark, "DROP TABLE x")
    with pytest.raises(ValueError):
        run_sql(spark, "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a")
    with pytest.raises(ValueError):
        run_sql(spark, "SET spark.sql.shuffle.partitions=3")
    assert run_sql(spark, "SELECT id FROM range(100)", top_k=7).count() == 7
    assert run_sql(spark, "SELECT 'last update' AS x -- delete nothing").first().x == "last update"
    assert run_sql(spark, "WITH a AS (SELECT 1 AS x) SELECT x FROM a").first().x == 1
    assert quote_table("data.gouv.fr.2022.clean") == "`data.gouv.fr.2022.clean`"
