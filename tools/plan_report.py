"""Physical-plan summary per registered plan (no result is collected).

usage: python tools/plan_report.py [sf_dir] [name ...]

Prints, from ``explain("formatted")``: parquet scans, sort-merge and
broadcast joins, window operators, and the distinct ReadSchema /
PushedFilters lines, to check pruning, pushdown and join strategy.
"""

from __future__ import annotations

import re
import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bidscope.plans.registry import load_all  # noqa: E402
from bidscope.session import get_session  # noqa: E402


def summary(df) -> str:
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_session(checkpoint=tempfile.mkdtemp(prefix="bidscope-tool-"))
    plans = load_all()
    for name in names or list(plans):
        text = summary(plans[name].build(spark, sf))
        print(f"== {name}: scans={text.count('Scan parquet')} smj={text.count('SortMergeJoin')} "
              f"bhj={text.count('BroadcastHashJoin')} windows={text.count('Window (')}")
        for line in sorted(set(re.findall(r"ReadSchema: struct<[^>]*>", text))):
            print("   ", line[:200])
        for line in sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", text))):
            print("   ", line[:200])


if __name__ == "__main__":
    main()
