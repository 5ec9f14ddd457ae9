"""Feature model with written levels, and its stages in pyspark.ml."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from bidscope.operators import features as FE
from bidscope.operators import mlstages as ML
from bidscope.session import scratch_path

SCHEMA = "uid string, montant double, idAccordCadre string, level string, position string, features string"
SPEC = FE.FeatureSpec(("montant",), ("idAccordCadre",), ("level", "position"))
TRAIN = [("a", 10.0, None, "x", "1", "old"), ("b", None, "k", "y", None, "old"), ("b", None, "k", "y", None, "old"),
         ("c", 99.0, "k", None, "2", None)]
HELD = [("d", 5.0, None, "new", "1", None), (None, None, None, None, None, None), ("e", 5.0, "k", "", "2", "old")]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def vectors(df):
    return [(r[0], list(r[1])) for r in df.select("uid", vector_to_array("features")).collect()]


def expected(rows):
    """By hand: numbers from the train rows, levels in order with 'missing'."""
    x = np.log1p([r[1] or 0.0 for r in TRAIN])
    levels = [sorted({r[i] or "missing" if r[i] is None else r[i] for r in TRAIN}) for i in (3, 4)]
    out = []
    for r in rows:
        v = [(np.log1p(r[1] or 0.0) - x.mean()) / x.std(), float(r[2] is not None)]
        for i, names in zip((3, 4), levels):
            v += [float(("missing" if r[i] is None else r[i]) == name) for name in names]
        out.append((r[0], v))
    return out


def same(got, want):
    def order(rows):
        return sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    assert [g[0] for g in order(got)] == [w[0] for w in order(want)]
    for g, w in zip(order(got), order(want)):
        assert np.allclose(g[1], w[1], atol=1e-12)


def test_vectors_equal_the_hand_made_ones(spark):
    """Nulls, unknown and empty levels, repeated rows, and columns that have
    the names of the levels' table and of the vector."""
    model = FE.fit(table(spark, TRAIN), SPEC)
    assert model.sizes == {"level": 3, "position": 3} and model.size == len(model.feature_names()) == 8
    assert model.feature_names()[2:5] == [f"cat_pipeline__level_{x}" for x in ("missing", "x", "y")]
    for rows in (TRAIN, HELD):
        encoded = model.encode(table(spark, rows))
        assert encoded.columns == ["uid", "montant", "idAccordCadre", "level", "position", "features"]
        same(vectors(encoded), expected(rows))
        wide = model.transform(table(spark, rows))
        assert wide.columns[1:] == model.feature_names()
        same([(r[0], list(r[1:])) for r in wide.collect()], expected(rows))
        long = model.transform_long(table(spark, rows)).filter("feature LIKE 'cat%'").count()
        assert long == sum(sum(v[2:]) for _, v in expected(rows))


def test_empty_tables(spark):
    model = FE.fit(table(spark, TRAIN), SPEC)
    assert model.encode(table(spark, [])).count() == 0 and model.transform_long(table(spark, [])).count() == 0
    none = FE.fit(table(spark, []), SPEC)
    assert none.sizes == {"level": 0, "position": 0} and len(none.feature_names()) == 2
    got = dict(vectors(none.encode(table(spark, TRAIN[:1]))))
    assert np.allclose(got["a"], [np.log1p(10.0), 0.0])


def test_wide_form_says_when_it_cannot_hold_the_levels(spark):
    model = FE.fit(table(spark, TRAIN), SPEC)
    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        with pytest.raises(ValueError, match="pivotMaxValues"):
            model.transform(table(spark, TRAIN))
        same(vectors(model.encode(table(spark, TRAIN))), expected(TRAIN))
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def many(spark):
    rng = np.random.default_rng(1)
    rows = [(str(i), float(rng.integers(1, 1000)), None if i % 3 else "k", f"l{i % 4}", f"only{i}", None) for i in range(60)]
    return table(spark, rows).withColumn("y", F.log1p("montant"))


def stages():
    features = ML.ContractFeatures(numerical=["montant"], categorical=["level", "position"], outputCol="vector")
    return features, LinearRegression(featuresCol="vector", labelCol="y", regParam=0.1)


def test_a_stored_pipeline_predicts_alike(spark):
    rows, path = many(spark), scratch_path(spark, "test-mlstages")
    model = ML.ContractPipeline(stages=list(stages())).fit(rows)
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert again.stages[0].uid == model.stages[0].uid and again.stages[0].getOutputCol() == "vector"
    want, got = (sorted(map(tuple, m.transform(rows).select("uid", "prediction").collect())) for m in (model, again))
    assert want == got
    stages()[0].write().overwrite().save(path + "-estimator")
    assert ML.ContractFeatures.load(path + "-estimator").spec() == stages()[0].spec()


def test_every_fold_fits_its_own_features(spark, monkeypatch):
    """``position`` has a level for each row: a fold's model has the levels of
    its training rows and of no held row."""
    seen, fit = [], FE.fit

    def watched(train, spec):
        model = fit(train, spec)
        seen.append((train.count(), model.sizes["position"]))
        return model
    monkeypatch.setattr(FE, "fit", watched)
    rows, (features, line) = many(spark).cache(), stages()
    grid = ParamGridBuilder().addGrid(line.regParam, [0.01, 0.1]).build()
    search = CrossValidator(estimator=ML.ContractPipeline(stages=[features, line]), estimatorParamMaps=grid, numFolds=3,
                            seed=4, parallelism=2, evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"))
    found = search.fit(rows)
    assert len(seen) == 4 and all(n == levels for n, levels in seen)     # once a fold, then on all rows
    assert sum(n for n, _ in seen[:3]) == 2 * 60 and seen[3][0] == 60
    assert np.isfinite(found.avgMetrics).all()
    # a setting of the features fits them anew for each of its values
    wide = ParamGridBuilder().addGrid(features.categorical, [["position"], ["level", "position"]]).build()
    assert [m.stages[0].spec().categorical for _, m in ML.ContractPipeline(stages=[features, line]).fitMultiple(rows, wide)] \
        == [("position",), ("level", "position")]
