"""The stored amount classifier: bins, early stop, another session."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from bidscope.operators import amountmodel as AM
from bidscope.operators import clean as C
from bidscope.operators import features as FE
from bidscope.operators import models as M
from bidscope.plans.registry import load_all
from bidscope.session import scratch_path
from bidscope.sources.tables import contracts

SF = "/root/testdata/sf0.001"


def test_bins_are_those_of_the_plan(spark):
    c = contracts(spark, SF)
    bins = AM.fit_bins(c)
    assert bins.classes == 8 and AM.fit_bins(c, 9, False).classes == 9 and AM.fit_bins(c, 100, False).classes == 100
    want = load_all()["bin_log_equal"].build(spark, SF).groupBy("amount_class").count().collect()
    got = c.groupBy(bins.of("montant").alias("amount_class")).count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    edge = spark.createDataFrame([(None,), (0.0,), (1e30,)], "montant double").select(bins.of("montant")).collect()
    assert [r[0] for r in edge] == [None, 0, 7]
    with pytest.raises(ValueError):
        AM.fit_bins(c.limit(0))
    same = AM.fit_bins(spark.createDataFrame([(5.0,), (5.0,)], "montant double"))
    assert spark.createDataFrame([(5.0,)], "montant double").select(same.of("montant")).first()[0] == 0


def points(spark, n, noise):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + noise * rng.normal(size=n) > 0).astype(float)
    rows = [(str(i), float(y[i]), x[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "uid string, label double, f array<double>").select("uid", "label", array_to_vector("f").alias("features"))


def test_stops_early_and_keeps_the_best_weights(spark):
    rows = points(spark, 400, 2.0)             # mostly noise: a wide net soon fits it
    found = M.mlp_early_stop(rows, 4, 2, hidden=(24,), rounds=40, per_round=10)
    assert len(found.losses) < 40 and found.best == len(found.losses) - 3
    assert found.losses[found.best] == min(found.losses)
    held = C.split_random(rows, 0.2, 43).filter("split = 'test'")
    p = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    loss = found.model.transform(held).agg(F.avg(-F.log(p))).first()[0]
    assert abs(loss - found.losses[found.best]) < 1e-9
    one = M.mlp_early_stop(rows.limit(1), 4, 2, hidden=(3,), rounds=2)
    assert np.isfinite(one.losses).all()


def test_learns_a_signal(spark):
    rows = points(spark, 400, 0.0)
    found = M.mlp_early_stop(rows, 4, 2, hidden=(8,))
    right = found.model.transform(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.95


def test_a_stored_model_predicts_in_another_session(spark):
    c = C.split_random(contracts(spark, SF), 0.2, 42)
    train, test = c.filter("split = 'train'"), c.filter("split = 'test'")
    model = AM.fit(train, AM.fit_bins(c), FE.preset("pred_montant"), hidden=(8,), rounds=2)
    path = scratch_path(spark, "test-amount-model")
    with pytest.raises(ValueError):
        AM.load(spark, path)
    model.save(spark, path)
    key = lambda r: (r.uid, r.label, r.prediction, [round(x, 9) for x in r.probability])
    want = sorted(map(key, model.predict(test).collect()), key=str)
    other = spark.newSession()
    again = C.split_random(contracts(other, SF), 0.2, 42).filter("split = 'test'")
    assert sorted(map(key, AM.load(other, path).predict(again).collect()), key=str) == want
    unknown = again.withColumn("montant", F.lit(None).cast("double")).withColumn("procedure", F.lit("never seen"))
    rows = AM.load(other, path).predict(unknown).collect()
    assert len(rows) == len(want) and all(r.label is None and abs(sum(r.probability) - 1) < 1e-6 for r in rows)


def test_the_plan_fits_the_references_net(spark):
    from bidscope.plans.p_models import amount_model
    layers = amount_model(spark, SF).network.getLayers()
    assert list(layers)[1:] == [1028, 512, 256, 8]


def test_gradients_are_those_of_sparks_model(spark):
    """Against differences of the loss, which is that of Spark's model of the
    same weights."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors
    from bidscope.operators import perceptron as PC
    rows, layers = points(spark, 60, 1.0), [4, 5, 3, 2]
    data, weights = PC.blocks(rows.withColumn("split", F.lit("train"))), PC.first_weights(layers, 1)
    model = MultilayerPerceptronClassifier(layers=layers, maxIter=0, initialWeights=Vectors.dense(weights)).fit(rows.limit(1))
    p = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    loss = PC.loss(data, weights, layers)
    assert loss == pytest.approx(model.transform(rows).agg(F.avg(-F.log(p))).first()[0], abs=1e-12)
    single, slope = PC.gradient(data, weights, layers)
    assert single == pytest.approx(loss, rel=1e-5)
    for at in (0, 13, 22, 27, 38, 44, len(weights) - 1):
        near = np.eye(len(weights))[at] * 1e-5
        assert slope[at] == pytest.approx((PC.loss(data, weights + near, layers) - PC.loss(data, weights - near, layers)) / 2e-5, abs=1e-5)
