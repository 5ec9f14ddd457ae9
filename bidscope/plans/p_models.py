"""§2.13 model, projection and clustering plans (rows-only checks: these
are iterative ML fits whose exact numbers depend on the optimiser)."""

from __future__ import annotations

import hashlib

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bidscope.functions.columns import bin_ranges
from bidscope.operators import amountmodel as AM
from bidscope.operators import clean as C
from bidscope.operators import features as FE
from bidscope.operators import models as M
from bidscope.operators import stats as ST
from bidscope.operators.mlstages import ContractFeatures
from bidscope.operators.quantiles import exact_quantiles, k_smallest_per_group
from bidscope.functions.columns import md5_key
from bidscope.operators.quantiles import hash_rank_value
from bidscope.plans.registry import plan
from bidscope.session import discard, scratch_path, stage_small as stage
from bidscope.sources.tables import contracts, contracts_staged


KEPT = ("label", "split", "montant", "categorie", "codeCPV_2")


def _selected(spark, sf, preset, *more):
    """What the features of ``preset`` read, and ``more``."""
    spec = FE.preset(preset)
    columns = dict.fromkeys(("uid", *spec.numerical, *spec.binary, *spec.categorical, *more))
    return FE.prepare(contracts(spark, sf)).select(*columns)


def _prepared(spark, sf, preset, *more):
    """Written once: a fit takes five passes."""
    return stage(_selected(spark, sf, preset, *more), "prepared")


def _assembled(spark, sf, preset="pred_montant", prepared=None, keep=KEPT):
    """The written table of vectors and the features' model."""
    own = prepared is None
    if own:
        prepared = _prepared(spark, sf, preset, *KEPT[2:])
    d = C.split_random(prepared, 0.2, 42).withColumn("label", bin_ranges("montant").cast("double"))
    fm = FE.fit(d.filter(F.col("split") == "train"), FE.preset(preset))
    a = stage(fm.assemble(d, keep=keep), "assembled")
    if own:
        discard(prepared)
    return a, fm


def _data(spark, sf, preset="pred_montant", prepared=None):
    a, fm = _assembled(spark, sf, preset, prepared)
    return a.filter(F.col("split") == "train"), a.filter(F.col("split") == "test"), fm


@plan("rf_amount_class", None, "2.13")
def rf_amount_class(spark, sf):
    tr, te, _ = _data(spark, sf)
    return M.rf_amount_class(tr, te)[0]


def amount_model(spark, sf):
    """The stored amount classifier of the table, read from the shared folder;
    the first plan of a run that asks fits and stores it."""
    path = scratch_path(spark, f"models/amount-{hashlib.md5(sf.encode()).hexdigest()[:12]}")
    if not AM.is_stored(spark, path):
        c = _prepared(spark, sf, "pred_montant", "montant")
        train = C.split_random(c, 0.2, 42).filter("split = 'train'")
        AM.fit(train, AM.fit_bins(c), FE.preset("pred_montant")).save(spark, path)
    return AM.load(spark, path)


def _test_predictions(spark, sf):
    return amount_model(spark, sf).predict(C.split_random(contracts(spark, sf), 0.2, 42).filter("split = 'test'"))


@plan("mlp_amount_class", None, "2.13")
def mlp_amount_class(spark, sf):
    """Eight log-amount classes, by a network that stops early."""
    return _test_predictions(spark, sf).select("uid", "label", "prediction")


@plan("predict_distribution", None, "2.13")
def predict_distribution(spark, sf):
    """Class probabilities by the stored model; nothing is refitted."""
    return M.predict_distribution(_test_predictions(spark, sf))


@plan("gbt_amount_reg", None, "2.13")
def gbt_amount_reg(spark, sf):
    tr, te, _ = _data(spark, sf)
    return M.gbt_amount_reg(tr, te)[0].select("uid", "montant", "pred_montant")


@plan("gbt_amount_class", None, "2.13")
def gbt_amount_class(spark, sf):
    c = _prepared(spark, sf, "pred_montant", "montant")
    q = stage(exact_quantiles(c, "montant", [k / 8 for k in range(1, 8)], [f"q{k}" for k in range(1, 8)]), "eighths")
    qb = sum(((F.col("montant") > F.col(f"q{k}")).cast("int") for k in range(2, 8)), (F.col("montant") > F.col("q1")).cast("int"))
    d = C.split_random(c, 0.2, 42).crossJoin(F.broadcast(q)).withColumn("label", qb.cast("double"))
    fm = FE.fit(d.filter(F.col("split") == "train"), FE.preset("pred_montant"))
    a = stage(fm.assemble(d, keep=("label", "split")), "assembled")
    discard(c)
    out, _ = M.gbt_amount_class(a.filter(F.col("split") == "train"), a.filter(F.col("split") == "test"))
    return out.select("uid", "label", "prediction")


@plan("linear_amount_reg", None, "2.13")
def linear_amount_reg(spark, sf):
    """Lasso, the reference's setting."""
    tr, te, _ = _data(spark, sf)
    return M.linear_amount_reg(tr, te, 0.8, 1.0)[0].select("uid", "montant", "prediction")


@plan("linear_amount_plain", None, "2.13")
def linear_amount_plain(spark, sf):
    tr, te, _ = _data(spark, sf)
    return M.linear_amount_reg(tr, te, 0.0, 0.0)[0].select("uid", "montant", "prediction")


@plan("linear_amount_elastic", None, "2.13")
def linear_amount_elastic(spark, sf):
    tr, te, _ = _data(spark, sf)
    return M.linear_amount_reg(tr, te, 0.1, 0.5)[0].select("uid", "montant", "prediction")


@plan("cross_validate", None, "2.13")
def cross_validate(spark, sf):
    """Contracts go in raw: every fold fits its own features."""
    tr = C.split_random(_selected(spark, sf, "pred_montant", "montant"), 0.2, 42).filter("split = 'train'")
    return M.cross_validate(tr, ContractFeatures.preset("pred_montant"), folds=5)[0]


@plan("grid_search", None, "2.13")
def grid_search(spark, sf):
    """Feature count × depth × trees, ranked by the median absolute
    percentage error over five folds."""
    tr, te, fm = _data(spark, sf)
    _, model = M.rf_amount_class(tr, te)
    importance = model.featureImportances.toArray()
    ranked = sorted(range(len(importance)), key=lambda i: (-importance[i], i))
    return M.grid_search(tr, ranked, counts=(10, 20), depths=(5, 10), trees=(10, 20))


@plan("feature_importance", None, "2.13")
def feature_importance(spark, sf):
    tr, te, fm = _data(spark, sf)
    _, model = M.rf_amount_class(tr, te)
    return M.feature_importance(model, fm.feature_names(), spark).join(
        M.permutation_importance(model, te, fm.feature_names()), "feature")


@plan("refit_top_features", None, "2.13")
def refit_top_features(spark, sf):
    """Amounts by boosted trees on the 27 features that a base model ranks
    first; both stop early."""
    tr, te, _ = _data(spark, sf)
    return M.predict_top_features(te, M.refit_top_features(tr, depth=10)).select("uid", "montant", "pred_montant")


@plan("random_search", None, "2.13")
def random_search(spark, sf):
    """Twenty draws of boosted trees over three folds."""
    return M.random_search(_data(spark, sf)[0])


def _components(spark, sf, prepared=None, keep=()):
    """Components fitted on the training rows; all rows on them, with the
    columns ``keep``; the table they are made of and the features' model."""
    a, fm = _assembled(spark, sf, "marche_sim", prepared, ("split", *keep))
    tr, te = a.filter(F.col("split") == "train"), a.filter(F.col("split") == "test")
    model = M.fit_pca(tr, 0.9)
    return M.pca_reduce(tr.unionByName(te), model).drop("features"), model, a, fm


def _pca(spark, sf, prepared=None, keep=()):
    """All rows on the components, written for several readers."""
    proj, model, a, fm = _components(spark, sf, prepared, keep)
    proj = stage(proj, "projected")
    discard(a)
    return proj, model, model.components.shape[1], fm


@plan("pca_reduce", None, "2.13")
def pca_reduce(spark, sf):
    proj, model, _, _ = _components(spark, sf)
    return proj.select("uid", F.lit(model.components.shape[1]).alias("k"), vector_to_array("pca").alias("pca"))


@plan("pca_loadings", None, "2.13")
def pca_loadings(spark, sf):
    _, model, _, fm = _components(spark, sf)
    return M.pca_loadings(model, fm.feature_names(), spark, top=5)


@plan("gmm_cluster", None, "2.13")
def gmm_cluster(spark, sf):
    proj, _, _, _ = _pca(spark, sf)
    out, _ = M.gmm_cluster(proj, 20)
    return out.select("uid", F.col("prediction").alias("cluster"), "max_probability")


@plan("kmeans_cluster", None, "2.13")
def kmeans_cluster(spark, sf):
    proj, _, _, _ = _pca(spark, sf)
    out, _ = M.kmeans_cluster(proj, 50)
    return out.select("uid", F.col("prediction").alias("cluster"))


@plan("silhouette", None, "2.13")
def silhouette(spark, sf):
    proj, _, _, _ = _pca(spark, sf)
    out, _ = M.kmeans_cluster(proj, 50)
    return M.silhouette(out)


@plan("assign_cluster", None, "2.13")
def assign_cluster(spark, sf):
    proj, _, _, _ = _pca(spark, sf)
    km, _ = M.kmeans_cluster(proj.filter(F.col("split") == "train"), 50)
    cents = stage(M.centroids(km.withColumnRenamed("prediction", "cluster")), "centroids")
    return M.assign_cluster(proj.filter(F.col("split") == "test"), cents)


@plan("similar_contracts", None, "2.13")
def similar_contracts(spark, sf):
    """For 5 sampled contracts: assigned cluster with its probability, its
    profile, and 5 member contracts of that cluster (smallest md5 order)."""
    prepared = _prepared(spark, sf, "marche_sim", *KEPT[2:])
    proj, _, _, _ = _pca(spark, sf, prepared, ("montant", "codeCPV_2"))
    km, _ = M.kmeans_cluster(proj.filter(F.col("split") == "train"), 50)
    members = stage(km.withColumnRenamed("prediction", "cluster"), "members")
    queries = C.sample_rows(proj.filter(F.col("split") == "test"), 5, 7)
    assigned = M.assign_cluster(queries, M.centroids(members))
    prof = ST.cluster_profile(stage(members.select("uid", "cluster", "codeCPV_2", "montant").join(prepared.select("uid", "dureeMois"), "uid"), "profile"), "cluster", "codeCPV_2", "montant", "dureeMois", 1) \
             .select("cluster", "size", "top_cpv", "median_amount", "median_duration")
    pick = members.join(assigned.select("cluster").distinct(), "cluster", "left_semi") \
                  .withColumn("_h", hash_rank_value(md5_key("uid", seed=11)))
    sample = k_smallest_per_group(pick, "_h", 5, ["cluster"]).select("cluster", F.col("uid").alias("similar_uid"))
    return assigned.withColumnRenamed("uid", "query_uid").join(prof, "cluster").join(sample, "cluster")


@plan("isolation_forest", None, "2.13")
def isolation_forest(spark, sf):
    """100 trees of 256 rows on robust-scaled amount/duration/bids,
    contamination 0.005 (the notebook setting)."""
    from bidscope.operators import iforest as IF
    c = C.split_random(contracts_staged(spark, sf, ["uid", "montant", "dureeMois", "offresRecues"]), 0.2, 42)
    train = c.filter(F.col("split") == "train")
    scaled = c
    for col in ("montant", "dureeMois", "offresRecues"):
        scaled = FE.scale_robust(train, scaled, col)
    scaled = stage(scaled.select("uid", "montant", "dureeMois", "offresRecues"), "scaled")
    return IF.isolation_forest(scaled, ["montant", "dureeMois", "offresRecues"], 0.005)
