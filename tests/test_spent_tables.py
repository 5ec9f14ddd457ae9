"""Written tables that are read no more are removed, and hold what is read."""
import glob
import os

from bidscope.operators import states as S
from bidscope.plans import p_flags, p_models
from bidscope.plans.registry import load_all
from bidscope.session import discard, scratch_path, stage_small as stage

SF = "/root/testdata/sf0.001"


def written(spark, name):
    return set(glob.glob(f"{scratch_path(spark, 'stage')}/{name}-*"))


def test_a_written_tables_shuffles_are_removed(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    table = stage(spark.range(1000).repartition(3, "id").groupBy("id").count(), "spent-test")
    assert table.count() == 1000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    assert any(".zstd." in x for x in os.listdir(table.staged_at))
    discard(table)
    assert not written(spark, "spent-test")


def test_rounds_keep_the_last_tables_only(spark):
    before = {n: written(spark, n) for n in ("edge-states", "node-states", "given")}
    nodes = stage(spark.createDataFrame([(i, [float(i)]) for i in range(4)], "id long, h array<double>"), "given")
    edges = stage(spark.createDataFrame([("u", 0, 1, [1.0]), ("v", 2, 1, [2.0])], "uid string, src long, dst long, h array<double>"), "given")
    got = S.state_rounds(nodes, edges, 3, spend=True)
    assert [x.count() for x in got] == [4, 2]
    assert [len(written(spark, n) - before[n]) for n in before] == [1, 1, 0]


def test_projected_contracts_replace_what_they_are_made_of(spark):
    names = ("prepared", "assembled", "projected")
    before = {n: written(spark, n) for n in names}
    assert p_models._pca(spark, SF)[0].columns == ["uid", "split", "pca"]
    assert [len(written(spark, n) - before[n]) for n in names] == [0, 0, 1]


def test_rules_write_the_columns_that_they_read(spark, monkeypatch):
    asked, run = [], p_flags.contracts_staged
    monkeypatch.setattr(p_flags, "contracts_staged", lambda spark, sf, columns=None: asked.append(columns) or run(spark, sf, columns))
    for name in ("identify_anomalies", "clean_dataset", "burst_members"):
        load_all()[name].build(spark, SF)
    assert all(c and len(c) <= 9 for c in asked) and len(asked) == 3
