"""Models, projections and clustering on Spark ML.

Built-ins do the distributed work: RandomForest/GBT/MLP/linear models,
CrossValidator, PCA, GaussianMixture, KMeans, ClusteringEvaluator.  Inputs
are the assembled feature vectors of ``features.FeatureModel``.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.classification import (GBTClassifier, MultilayerPerceptronClassificationModel,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from bidscope.functions.columns import dbl, log1p_clip_inverse
from bidscope.operators import perceptron as PC
from bidscope.operators.clean import split_random
from bidscope.operators.mlstages import ContractPipeline
from bidscope.operators.quantiles import exact_quantiles
from bidscope.operators.stats import dense_ids
from bidscope.session import stage_small as stage


def class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """'balanced' weights n / (k · n_c) from per-class counts (k classes)."""
    cnt = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = cnt.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = cnt.crossJoin(F.broadcast(tot)).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label)   # one row per class


def rf_amount_class(train: DataFrame, test: DataFrame, trees: int = 100, seed: int = 42) -> DataFrame:
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                numTrees=trees, seed=seed)
    model = rf.fit(class_weights(train))
    return model.transform(test).select("uid", "label", "prediction",
                                        vector_to_array("probability").alias("probability")), model


class EarlyStopped(NamedTuple):
    model: MultilayerPerceptronClassificationModel
    losses: list[float]           # on the held rows, a round each
    best: int                     # the round whose weights were kept


def mlp_early_stop(train: DataFrame, n_features: int, n_classes: int, hidden: Sequence[int] = (1028, 512, 256),
                   rounds: int = 30, per_round: int = 5, patience: int = 2, share: float = 0.2,
                   seed: int = 42, key: str = "uid") -> EarlyStopped:
    """A network fitted in rounds of ``per_round`` iterations, each from the
    weights of the one before.  After a round the cross-entropy of the held
    ``share`` of the rows is taken; ``patience`` rounds without a lower one end
    the fit, and the weights of the lowest are kept.  Sigmoid units, L-BFGS
    (``perceptron``); the widths are the reference's.  Without a held row (few
    rows) the loss is that of the fitted ones."""
    data = PC.blocks(split_random(train.select(key, "label", "features"), share, seed + 1))
    fitted, held = data.filter("split = 'train'"), data.filter("split = 'test'")
    if held.isEmpty():
        held = fitted
    layers = [n_features, *hidden, n_classes]
    search = PC.Lbfgs(PC.first_weights(layers, seed), lambda w: PC.gradient(fitted, w, layers))
    best, losses = None, []
    for number in range(rounds):
        search.run(per_round)
        losses.append(PC.loss(held, search.weights, layers))
        if best is None or losses[-1] < losses[best[0]]:
            best = (number, search.weights)
        elif number - best[0] >= patience:
            break
    # no iteration: Spark's model around the weights, by its own way to make one
    net = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=layers, maxIter=0, initialWeights=Vectors.dense(best[1]))
    return EarlyStopped(net.fit(train.limit(1)), losses, best[0])


def predict_distribution(pred: DataFrame) -> DataFrame:
    """(uid, class, probability) rows from a probability vector."""
    return pred.select("uid", F.posexplode(vector_to_array("probability")).alias("class", "probability"))


def gbt_amount_reg(train: DataFrame, test: DataFrame, seed: int = 42, max_iter: int = 50) -> DataFrame:
    """Boosted trees on log1p(amount); predictions back-transformed with
    expm1(clip(·, 0, 20))."""
    tr = train.withColumn("y", F.log1p("montant"))
    model = GBTRegressor(featuresCol="features", labelCol="y", seed=seed, maxIter=max_iter).fit(tr)
    return model.transform(test).withColumn("pred_montant", log1p_clip_inverse("prediction")), model


def gbt_amount_class(train: DataFrame, test: DataFrame, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """Multi-class boosted trees: one-vs-rest over binary GBTs."""
    ovr = OneVsRest(classifier=GBTClassifier(seed=seed, maxIter=max_iter), featuresCol="features", labelCol="label")
    model = ovr.fit(train)
    return model.transform(test), model


def linear_amount_reg(train: DataFrame, test: DataFrame, reg: float = 0.8, elastic: float = 1.0):
    """Linear model of log1p(amount): plain (reg 0), Lasso (elastic 1) or
    elastic net."""
    tr = train.withColumn("y", F.log1p("montant"))
    model = LinearRegression(featuresCol="features", labelCol="y", regParam=reg, elasticNetParam=elastic).fit(tr)
    return model.transform(test), model


def cross_validate(train: DataFrame, features: Estimator, folds: int = 5, seed: int = 42, parallelism: int = 4):
    """Grid over regParam × elasticNetParam, k-fold CV on RMSE of log1p(amount)
    for rows that have an amount.  ``features`` is fitted on the training rows
    of each fold, so that no held row tells a median, scale or level."""
    tr = stage(train.withColumn("y", F.log1p("montant")).where("y IS NOT NULL"), "folds")
    lr = LinearRegression(featuresCol=features.getOutputCol(), labelCol="y")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1, 0.8]).addGrid(lr.elasticNetParam, [0.0, 1.0]).build()
    cv = CrossValidator(estimator=ContractPipeline(stages=[features, lr]), estimatorParamMaps=grid, numFolds=folds, seed=seed, parallelism=parallelism,
                        evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"))
    m = cv.fit(tr)
    rows = [(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(v))
            for p, v in zip(grid, m.avgMetrics)]
    return train.sparkSession.createDataFrame(rows, "regParam double, elasticNetParam double, rmse double"), m


def grid_search(train: DataFrame, ranked: Sequence[int], counts: Sequence[int], depths: Sequence[int],
                trees: Sequence[int], folds: int = 5, seed: int = 42) -> DataFrame:
    """Random forests of log1p(amount) on the ``counts`` most important
    features (``ranked``: feature numbers, best first) × depth × trees, by the
    median absolute percentage error over folds of the training rows.  A row's
    fold is its md5's; the median is the exact order statistic."""
    spark = train.sparkSession
    rows = train.withColumn("y", F.log1p("montant")).withColumn("_fold", F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", "uid", F.lit(seed))), 1, 8), 16, 10).cast("long"), F.lit(folds)))
    out = []
    for n in counts:
        cut = VectorSlicer(inputCol="features", outputCol="_cut", indices=list(ranked[:n])).transform(rows)
        for depth in depths:
            for t in trees:
                scored = None
                for f in range(folds):
                    model = RandomForestRegressor(featuresCol="_cut", labelCol="y", maxDepth=depth, numTrees=t, seed=seed).fit(cut.filter(F.col("_fold") != f))
                    part = model.transform(cut.filter(F.col("_fold") == f)).select(
                        (F.abs(log1p_clip_inverse("prediction") - F.col("montant")) / F.col("montant")).alias("ape"))
                    scored = part if scored is None else scored.unionByName(part)
                mdape = exact_quantiles(scored.filter("ape IS NOT NULL"), "ape", [0.5], ["mdape"]).first()["mdape"]
                out.append((n, depth, t, float(mdape)))
    return spark.createDataFrame(out, "n_features int, max_depth int, n_trees int, mdape double").orderBy("mdape", "n_features", "max_depth", "n_trees")


class Boosted(NamedTuple):
    model: object
    used: list[int]               # numbers of the features it was fitted on, best first
    trees: int                    # grown until the held rows gained no more


def boosted_early_stop(train: DataFrame, trees: int = 500, depth: int = 30, step: float = 0.05, rows_share: float = 1.0,
                       columns_share: float = 1.0, share: float = 0.2, seed: int = 42, features: str = "features",
                       key: str = "uid") -> GBTRegressionModel:
    """Boosted trees of log1p(amount), ended when the error of a held
    ``share`` of the rows falls no more (Spark's ``validationIndicatorCol``).
    A tree sees ``rows_share`` of the rows, a node ``columns_share`` of the features."""
    rows = split_random(train.drop("split").withColumn("y", F.log1p("montant")), share, seed + 1, key)
    return GBTRegressor(featuresCol=features, labelCol="y", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed,
                        subsamplingRate=rows_share, featureSubsetStrategy="all" if columns_share >= 1 else str(columns_share),
                        validationIndicatorCol="_held").fit(rows.withColumn("_held", F.col("split") == "test"))


def refit_top_features(train: DataFrame, k: int = 27, trees: int = 500, depth: int = 30, base_trees: int = 100,
                       base_depth: int = 6, step: float = 0.05, seed: int = 42) -> Boosted:
    """A base model on all features ranks them; the final one is fitted on the
    ``k`` that lower the error most (ties to the smaller number), or all if
    there are fewer."""
    base = boosted_early_stop(train, base_trees, base_depth, step, seed=seed)
    weight = base.featureImportances.toArray()
    used = sorted(range(len(weight)), key=lambda i: (-weight[i], i))[:k]
    cut = VectorSlicer(inputCol="features", outputCol="_cut", indices=used).transform(train)
    model = boosted_early_stop(cut, trees, depth, step, seed=seed, features="_cut")
    return Boosted(model, used, model.getNumTrees)


def predict_top_features(df: DataFrame, fitted: Boosted) -> DataFrame:
    cut = VectorSlicer(inputCol="features", outputCol="_cut", indices=fitted.used).transform(df)
    return fitted.model.transform(cut).withColumn("pred_montant", log1p_clip_inverse("prediction"))


#: What the reference's random search draws from.
SEARCHED = {"trees": (200, 500, 800), "depth": (3, 6, 9), "step": (0.01, 0.1, 0.2),
            "rows_share": (0.6, 0.8, 1.0), "columns_share": (0.6, 0.8, 1.0)}


def random_search(train: DataFrame, draws: int = 20, folds: int = 3, seed: int = 42, at_once: int = 4,
                  searched: dict[str, Sequence] = SEARCHED, key: str = "uid") -> DataFrame:
    """Boosted trees at ``draws`` different points of ``searched``, drawn by
    ``seed``, by the mean absolute error of the amounts of the fold that a fit
    has not seen.  All candidates read one written table; ``at_once`` fits run
    side by side.  One row per draw, the best first; rows without an amount
    are left out."""
    spark = train.sparkSession
    points = list(itertools.product(*searched.values()))
    chosen = [dict(zip(searched, p)) for p in random.Random(seed).sample(points, min(draws, len(points)))]
    fold = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", key, F.lit(seed))), 1, 8), 16, 10).cast("long"), F.lit(folds))
    rows = stage(train.where(F.col("montant").isNotNull()).select(key, "features", "montant", fold.alias("_fold")), "search")

    def error(task: tuple[int, int]) -> tuple[int, float, int, int]:
        number, left = task
        model = boosted_early_stop(rows.where(F.col("_fold") != left), seed=seed, key=key, **chosen[number])
        off = F.abs(log1p_clip_inverse("prediction") - F.col("montant"))
        found = model.transform(rows.where(F.col("_fold") == left)).agg(F.sum(off).alias("off"), F.count(off).alias("n")).first()
        return number, found["off"] or 0.0, found["n"], model.getNumTrees
    with ThreadPool(at_once) as pool:
        errors = pool.map(inheritable_thread_target(spark)(error), itertools.product(range(len(chosen)), range(folds)), chunksize=1)
    out = []
    for number, point in enumerate(chosen):
        own = [e for e in errors if e[0] == number]
        n = sum(e[2] for e in own)
        out.append((number, *(float(v) for v in point.values()), max(e[3] for e in own), sum(e[1] for e in own) / n if n else None))
    names = ", ".join(f"{name} double" for name in searched)
    return spark.createDataFrame(out, f"draw int, {names}, grown int, mae double").orderBy("mae", "draw")


def permutation_importance(model, test: DataFrame, names: Sequence[str], label: str = "label", seed: int = 42) -> DataFrame:
    """Loss of accuracy on ``test`` when one feature is shuffled among the
    rows.  The shuffle joins two numberings of the rows by hashed order; all
    features are scored in one job, a row for each, which is bounded by the
    feature vector."""
    spark = test.sparkSession
    base = test.select("uid", label, "features")

    def ordered(salt: str) -> DataFrame:
        keyed = base.withColumn("_k", F.md5(F.concat_ws(":", "uid", F.lit(f"{salt}{seed}"))))
        return keyed.join(dense_ids(keyed.select("_k"), "_k", "_n"), "_k")
    correct = F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy")
    right = model.transform(base).agg(correct).first()["accuracy"]
    a = ordered("a").select("_n", label, vector_to_array("features").alias("_a"))
    b = ordered("b").select("_n", vector_to_array("features").alias("_b"))
    mixed = F.transform("_a", lambda v, j: F.when(j == F.col("_i"), F.element_at("_b", F.col("_i") + 1)).otherwise(v))
    rows = a.join(b, "_n").select(label, "_a", "_b", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("_i")) \
            .select(label, "_i", array_to_vector(mixed).alias("features"))
    scored = model.transform(rows).groupBy("_i").agg(correct)
    named = spark.createDataFrame(list(enumerate(names)), "_i int, feature string")
    return scored.join(named, "_i").select("feature", (F.lit(right) - F.col("accuracy")).alias("accuracy_loss"))


def feature_importance(model, names: Sequence[str], spark, top: int | None = None) -> DataFrame:
    """Tree-ensemble importances as (feature, importance, rank)."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")
    w = Window.orderBy(F.desc("importance"), "feature")   # one row per feature: bounded
    out = df.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= top) if top else out


# ---------------------------------------------------------------- PCA
class Projection(NamedTuple):
    """Principal components of the training rows."""
    mean: np.ndarray
    components: np.ndarray        # features × k
    explained: np.ndarray         # variance share of each of the k


def fit_pca(train: DataFrame, variance: float = 0.9, features: str = "features") -> Projection:
    """Components of the centred (not rescaled) training rows: one fit, cut
    at the fewest components that explain ``variance``."""
    mean = train.select(Summarizer.mean(F.col(features)).alias("m")).first()["m"].toArray()
    # the covariance behind the fit centres the columns by itself
    full = PCA(k=len(mean), inputCol=features, outputCol="_pca").fit(train)
    share = full.explainedVariance.toArray()
    k = min(len(share), int(np.searchsorted(np.cumsum(share), variance - 1e-12)) + 1)
    return Projection(mean, full.pc.toArray()[:, :k], share[:k])


def pca_reduce(df: DataFrame, model: Projection, features: str = "features", out: str = "pca") -> DataFrame:
    """``df`` with its rows' coordinates on the fitted components."""
    shared = df.sparkSession.sparkContext.broadcast(model)      # features × k numbers

    @F.pandas_udf("array<double>")
    def project(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()) if len(v) else np.empty((0, len(shared.value.mean)))
        return pd.Series(list((x - shared.value.mean) @ shared.value.components))
    return df.withColumn(out, array_to_vector(project(vector_to_array(features))))


def pca_loadings(model: Projection, names: Sequence[str], spark, top: int = 5) -> DataFrame:
    """Top |weight| features per component with the direction of the effect."""
    pc = model.components
    rows = [(j, names[i], float(pc[i, j])) for j in range(pc.shape[1]) for i in range(pc.shape[0])]
    df = spark.createDataFrame(rows, "component int, feature string, weight double")
    w = Window.partitionBy("component").orderBy(F.desc(F.abs("weight")), "feature")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top) \
             .withColumn("direction", F.when(F.col("weight") > 0, F.lit("increases")).otherwise(F.lit("decreases")))


def reconstruction_error(df: DataFrame, model: Projection, features: str = "features") -> DataFrame:
    """mean over features of (x − x̂)² with x̂ = m + P Pᵀ (x − m) (the rank-k
    linear auto-encoder given by the components)."""
    shared = df.sparkSession.sparkContext.broadcast(model)      # bounded by the feature count

    @F.pandas_udf(DoubleType())
    def _err(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()) - shared.value.mean
        pc = shared.value.components
        return pd.Series(((x - x @ pc @ pc.T) ** 2).mean(axis=1))
    return df.withColumn("recon_error", _err(vector_to_array(features)))


# ---------------------------------------------------------------- clustering
def gmm_cluster(df: DataFrame, k: int = 20, seed: int = 42, features: str = "pca"):
    m = GaussianMixture(k=k, seed=seed, featuresCol=features).fit(df)
    out = m.transform(df).withColumn("max_probability", F.array_max(vector_to_array("probability")))
    return out, m


def kmeans_cluster(df: DataFrame, k: int = 50, seed: int = 42, features: str = "pca"):
    m = KMeans(k=k, seed=seed, featuresCol=features).fit(df)
    return m.transform(df), m


def silhouette(pred: DataFrame, features: str = "pca", cluster: str = "prediction") -> DataFrame:
    """Mean silhouette (squared Euclidean) over non-noise points."""
    p = pred.filter(F.col(cluster) >= 0)
    s = ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(p)
    return pred.sparkSession.createDataFrame([(float(s),)], "silhouette double")


def centroids(members: DataFrame, features: str = "pca", cluster: str = "cluster") -> DataFrame:
    """One row per cluster: the mean of its members (noise excluded)."""
    return members.filter(F.col(cluster) >= 0).groupBy(cluster).agg(Summarizer.mean(F.col(features)).alias("_c")) \
                  .select(cluster, vector_to_array("_c").alias("centroid"))


def assign_cluster(new: DataFrame, cents: DataFrame, features: str = "pca", cluster: str = "cluster",
                   key: str = "uid") -> DataFrame:
    """Nearest centroid of each new row (ties to the smaller cluster), its
    distance, and the probability: the share of exp(−d/2) of it among all
    centroids.  All centroids are one array (one row per cluster, clusters
    being a parameter of the clustering), so no row is multiplied or moved."""
    every = cents.agg(F.sort_array(F.collect_list(F.struct(F.col(cluster).alias("cluster"), "centroid"))).alias("_cents"))
    x = new.select(key, vector_to_array(features).alias("_x")).crossJoin(F.broadcast(every))
    square = lambda c: F.aggregate(F.zip_with("_x", c, lambda a, b: (a - b) * (a - b)), dbl(0), lambda acc, y: acc + y)
    ds = F.transform("_cents", lambda c: F.struct(square(c["centroid"]).alias("distance"), c["cluster"].alias("cluster")))
    x = x.withColumn("_d", ds).withColumn("_best", F.array_min("_d"))
    near = F.aggregate("_d", dbl(0), lambda acc, d: acc + F.exp((F.col("_best.distance") - d["distance"]) / 2))
    return x.select(key, F.col("_best.cluster").alias(cluster), F.col("_best.distance").alias("distance"), (dbl(1) / near).alias("probability"))


def exemplars(members: DataFrame, order: Column, per: int = 10, cluster: str = "cluster", key: str = "uid", vector: str = "v") -> DataFrame:
    """(cluster, exemplar): the first ``per`` rows of each cluster by
    ``order`` (ties by key), such as the densest ones; noise has none."""
    first = Window.partitionBy(cluster).orderBy(order, key)
    known = members.where(F.col(cluster).isNotNull() & (F.col(cluster).cast("string") != "-1"))
    return known.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= per).select(cluster, F.col(vector).alias("exemplar"))


def assign_exemplar(new: DataFrame, chosen: DataFrame, cluster: str = "cluster", key: str = "uid", vector: str = "v") -> DataFrame:
    """The cluster of each row's nearest exemplar (ties to the smaller
    cluster) and its distance.  Exemplars are a bounded number per cluster, and
    travel as one array; without any the cluster is null."""
    every = chosen.agg(F.collect_list(F.struct(F.col(cluster).alias("cluster"), "exemplar")).alias("_ex"))
    far = lambda e: F.sqrt(F.aggregate(F.zip_with(vector, e, lambda a, b: (a - b) * (a - b)), dbl(0), lambda acc, y: acc + y))
    near = F.array_min(F.transform("_ex", lambda e: F.struct(far(e["exemplar"]).alias("distance"), e["cluster"].alias("cluster"))))
    x = new.select(key, vector).crossJoin(F.broadcast(every)).withColumn("_best", near)
    return x.select(key, F.col("_best.cluster").alias(cluster), F.col("_best.distance").alias("distance"))
