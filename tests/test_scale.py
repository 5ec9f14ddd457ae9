"""Queries read what they share once, from a written table."""

import time

from pyspark.sql import functions as F

from bidscope.operators import enrich as E
from bidscope.operators import graph as G


def test_mapping_reads_its_rows_once_and_makes_needed_prefixes_only(spark, tmp_path):
    rows = [("45000000-7",), ("4500",), ("4500",), ("99",), (None,)]
    spark.createDataFrame(rows, "codeCPV string").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    cpv = spark.createDataFrame([("45000000-7", "a"), ("45001111-1", "b"), ("46", "c")], "CODE string, FR string")
    mapping = E.cpv_mapping(df, cpv)
    assert not any(str(tmp_path) in f for f in mapping.inputFiles())
    found = {tuple(r) for r in mapping.collect()}
    assert found == {("45000000-7", "a"), ("4500", "a"), ("99", None)}
    lengths = spark.createDataFrame([(2,), (10,), (None,)], "_len int")
    assert sorted(r.prefix for r in E.code_prefixes(cpv, lengths=lengths).collect()) == ["45", "45", "45000000-7", "45001111-1", "46"]
    described = sorted(E.cpv_description(df, cpv).collect(), key=str)
    assert len(described) == 5 and sum(r.codeCPV_FR == "a" for r in described) == 3


def test_scores_are_made_once_for_threshold_and_flag(spark):
    """A score that is another one at every pass: the flag is still the one of its own threshold."""
    @F.udf("double")
    def now(_):
        return time.time()
    scores = spark.range(400, numPartitions=2).withColumn("err", now.asNondeterministic()("id"))
    flagged = G.threshold_flag(scores, "err", 5.0).toPandas()
    assert (flagged.is_anomaly == (flagged.err > flagged.threshold)).all()
    assert 1 <= flagged.is_anomaly.sum() <= 20


def test_rows_of_an_injection_are_joined_once_a_consumer(spark):
    """The result is not written whole: a consumer of labels reads labels."""
    from bidscope.operators import inject as IJ
    p = IJ.InjectParams(category="categorie")
    rows = [(f"u{i}", f"b{i % 7}", f"s{i % 5}", "c", float(i + 1), 12.0, "2023-01-05", 3.0, "Procédure adaptée", 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, "uid string, acheteur_id string, titulaire_id string, categorie string, montant double, "
                               "dureeMois double, dateNotification string, offresRecues double, procedure string, sousTraitanceDeclaree double")
    assert set(IJ.inputs(p)) == set(df.columns)
    out = IJ.inject_replace(df, IJ.TYPES, p)
    assert "Join" in out._jdf.queryExecution().optimizedPlan().toString()
    found = out.toPandas()
    assert sorted(found.uid) == sorted(r[0] for r in rows) and (found.is_synthetic_anomaly > 0).any()


def test_centroids_are_means_of_members(spark):
    from pyspark.ml.linalg import Vectors
    from bidscope.operators import models as M
    df = spark.createDataFrame([(0, Vectors.dense(1.0, 2.0)), (0, Vectors.dense(3.0, 6.0)), (1, Vectors.sparse(2, [1], [4.0])),
                                (-1, Vectors.dense(9.0, 9.0))], ["cluster", "pca"])
    plan = M.centroids(df)
    assert {r.cluster: list(r.centroid) for r in plan.collect()} == {0: [2.0, 4.0], 1: [0.0, 4.0]}
    assert "Generate" not in plan._jdf.queryExecution().optimizedPlan().toString()
