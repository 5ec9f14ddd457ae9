"""Benchmark: headline plans at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each plan is executed completely through the ``noop`` sink (no driver
collect).  Prints one JSON line:
{"metric": "total_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "anomaly_report",
    "identify_anomalies",
    "clean_dataset",
    "flag_price_inflation",
    "burst_members_loose",
    "cpv_description",
    "enrich_registry",
    "percentile_exact",
    "cluster_profile",
    "feature_pipeline",
    "node_features",
    "message_pass",
    "dense_ids",
    "split_stratified",
    "inject_replace",
    "roc_auc",
    "tfidf",
    "chunk_documents",
    "vector_topk",
    "knn_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from bidscope.plans.registry import load_all
    from bidscope.session import get_session
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                        checkpoint=tempfile.mkdtemp(prefix="bidscope-bench-"))
    plans = load_all()
    spark.range(1000).selectExpr("sum(id)").collect()    # JVM/codegen warm-up, not timed
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        plans[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
