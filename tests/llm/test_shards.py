"""Invariants of the two-pass shuffle."""
import zlib
from collections import Counter

import numpy as np
import pytest

from bidscope.llm import shards as S
from bidscope.llm.queries import QUERIES


def test_query(spark):
    d = "/root/testdata/sf0.001"
    got = QUERIES["op2_two_pass_shuffle"](spark, d).toPandas()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert sorted(got.doc_id) == sorted(docs)
    for r in got.itertuples():
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    counts = got.groupby("shard").size()
    assert set(counts.index) <= set(range(24)) and counts.max() - counts.min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    order = got.sort_values(["shard", "slot"]).doc_id.to_numpy()
    assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.3


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(S.fisher_yates(3, seed, 1).tolist()) for seed in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert S.fisher_yates(0, 1, 1).tolist() == [] and S.fisher_yates(1, 1, 1).tolist() == [0]


@pytest.mark.parametrize("bucket_bytes", [1, 1 << 20])
def test_edges(spark, tmp_path, bucket_bytes):
    rows = [(1, "same")] * 40 + [(None, None), (2, ""), (3, "long " * 50000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as shard", "1 as bucket", "2.5 as other").repartition(4)
    out = S.shuffle_into(df, str(tmp_path / "a"), 5, seed=3, bucket_bytes=bucket_bytes)
    assert out.columns == ["doc_id", "text", "other", "size", "shard", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 5
    assert {(r.shard, r.slot) for r in got} == {(s, i) for s, n in counts.items() for i in range(n)}
    again = S.shuffle_into(df, str(tmp_path / "b"), 5, seed=3, bucket_bytes=bucket_bytes).collect()
    key = lambda r: (r.shard, r.slot)
    assert sorted(map(str, got)) == sorted(map(str, again)) and sorted(map(key, got)) == sorted(map(key, again))
    assert S.shuffle_into(df.limit(0), str(tmp_path / "c"), 5).count() == 0
