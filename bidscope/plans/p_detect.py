"""§2.12 and §2.13 plans of the chained detector and of density clustering
(fits: checked by tests on small data with known answers)."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bidscope.functions.columns import cpv_level
from bidscope.operators import clean as C
from bidscope.operators import density as DN
from bidscope.operators import detector as D
from bidscope.operators import evaluate as EV
from bidscope.operators import features as FE
from bidscope.operators import graph as G
from bidscope.operators import inject as IJ
from bidscope.operators import neighbors as NB
from bidscope.plans import p_inject as PI
from bidscope.plans.registry import plan
from bidscope.session import scratch_path, stage_small as stage
from bidscope.sources.tables import contracts, contracts_staged

# of a contract: what its features, the graph and the detector's tables read
COLUMNS = ["uid", "acheteur_id", "titulaire_id", "montant", "dureeMois", "offresRecues", "sousTraitanceDeclaree", "origineFrance",
           "marcheInnovant", "idAccordCadre", "procedure", "nature", "formePrix", "ccag", "typeGroupementOperateurs", "tauxAvance",
           "codeCPV", "dateNotification"]
PERCENT = 5.0                 # of rows above the threshold


def _split(df):
    return C.split_random(FE.prepare(df), 0.2, 42)


def _rows(spark, sf):
    """Contracts with what the detector reads, written once and split."""
    return _split(contracts_staged(spark, sf, COLUMNS))


def _nodes(spark, sf):
    """Entities of all contracts, scored by what training contracts taught."""
    rows = C.split_random(contracts_staged(spark, sf, ["uid", "acheteur_id", "titulaire_id", *D.NUMERIC]), 0.2, 42)
    graph, err = D.node_errors(rows.filter("split = 'train'"), rows)
    return graph, stage(G.threshold_flag(err, "recon_error", PERCENT, written=True), "flagged-nodes")


def _injected(spark, sf):
    """The table with injected anomalies, split; types stay as labels."""
    rows = IJ.inject_replace(contracts(spark, sf).select(*COLUMNS, "categorie"), IJ.TYPES, PI.P)
    return _split(stage(rows.withColumnRenamed("is_synthetic_anomaly", "t"), "injected"))


@plan("recon_error_nodes", None, "2.12")
def recon_error_nodes(spark, sf):
    return _nodes(spark, sf)[1].select("id", "recon_error", "threshold", "is_anomaly")


@plan("detector_nodes", None, "2.12")
def detector_nodes(spark, sf):
    """Every entity with its features, error and flag."""
    graph, flagged = _nodes(spark, sf)
    return graph.stats.join(flagged.select("id", "recon_error", "is_anomaly"), "id")


@plan("recon_error_edges", None, "2.12")
def recon_error_edges(spark, sf):
    rows = _rows(spark, sf)
    return G.threshold_flag(D.edge_errors(rows.filter("split = 'train'"), rows), "recon_error", PERCENT)


@plan("detector_edges", None, "2.12")
def detector_edges(spark, sf):
    """Every contract with its payload, error and flag."""
    rows = _rows(spark, sf)
    err = G.threshold_flag(D.edge_errors(rows.filter("split = 'train'"), rows), "recon_error", PERCENT)
    return rows.join(err, "uid").select("uid", "recon_error", "is_anomaly", "acheteur_id", "titulaire_id", "montant",
                                        cpv_level("codeCPV", 3).alias("codeCPV_3"), "procedure", "dateNotification")


@plan("detector_by_type", None, "2.12")
def detector_by_type(spark, sf):
    """Detection by type of injected anomaly: fitted on the training split of
    the clean table, errors on the injected one."""
    clean = _rows(spark, sf)
    rows = _injected(spark, sf)
    err = G.threshold_flag(D.edge_errors(clean.filter("split = 'train'"), rows), "recon_error", PERCENT)
    scored = rows.select("uid", "t").join(err, "uid").withColumnRenamed("is_anomaly", "flag")
    return EV.detection_by_type(scored, "t", "flag", PERCENT)


@plan("detector_sink", None, "2.1")
def detector_sink(spark, sf):
    """Write the node table, the edge table and the node states to the shared
    folder; read them back as counts."""
    graph, flagged = _nodes(spark, sf)
    base = scratch_path(spark, f"detector/{uuid.uuid4().hex[:12]}")
    tables = {"nodes": graph.stats.join(flagged.select("id", "recon_error", "is_anomaly"), "id"),
              "edges": detector_edges(spark, sf), "states": flagged.select("id", "features")}
    out = None
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
        n = spark.read.parquet(f"{base}/{name}").agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_rows"))
        out = n if out is None else out.unionByName(n)
    return out


@plan("anomalous_communities", None, "2.12")
def anomalous_communities(spark, sf):
    """Density clusters of the flagged entities and their neighbours."""
    graph, flagged = _nodes(spark, sf)
    return D.communities(graph, flagged.select("id", "features"), flagged.filter("is_anomaly").select("id"), 0.5, 2)


def _plane(spark, sf):
    """Contracts by the logarithms of amount and duration."""
    return contracts(spark, sf).select("uid", F.log10(F.greatest("montant", F.lit(1.0))).alias("x"),
                                       F.log1p(F.coalesce("dureeMois", F.lit(0.0))).alias("y"))


@plan("dbscan_plane", None, "2.13")
def dbscan_plane(spark, sf):
    return DN.dbscan(_plane(spark, sf), ["x", "y"], 0.05, 20)


@plan("density_plane", None, "2.13")
def density_plane(spark, sf):
    return DN.density_cluster(_plane(spark, sf), ["x", "y"], 50, 20, 0.05)


def _projected(spark, sf):
    """All contracts on the components of the similarity features."""
    from bidscope.plans.p_models import _pca
    return _pca(spark, sf)[0].select("uid", vector_to_array("pca").alias("v"))


@plan("dbscan", None, "2.13")
def dbscan(spark, sf):
    """Projected features, all components, exact distances."""
    return NB.dbscan(_projected(spark, sf), "v", 0.5, 5)


@plan("density_cluster", None, "2.13")
def density_cluster(spark, sf):
    return NB.density_cluster(_projected(spark, sf), "v", 55, 20, 0.3)


@plan("density_counts", None, "2.13")
def density_counts(spark, sf):
    return DN.cluster_counts(density_cluster(spark, sf))
