"""Buyer–supplier graph as two DataFrames.

nodes(id, entity, node_type)  — buyers type 0 (ids 0..B-1 in key order),
                                 suppliers type 1 (ids B..B+S-1); the same key
                                 in both roles gives two nodes.
edges(uid, src, dst)           — one edge per contract, buyer → supplier.

Node statistics are one ``groupBy`` per role (partial aggregation: a buyer
holding a third of the contracts costs one pre-aggregated row per map task).
A round of message passing joins the counted edges with one state row per
node and adds them up per receiver, partially aggregated; every round is
checkpointed to the shared folder so lineage stays one round deep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.columns import dbl
from bidscope.operators.quantiles import exact_quantile_row
from bidscope.operators.stats import dense_ids
from bidscope.session import cut_lineage, stage_small as stage

BUYER, SUPPLIER = 0, 1


def graph_nodes(df: DataFrame, buyer: str = "acheteur_id", supplier: str = "titulaire_id") -> DataFrame:
    b = dense_ids(df.select(F.col(buyer).alias("entity")), "entity", "id")
    n_b = b.agg(F.count(F.lit(1)).alias("_nb"))          # one row
    s = dense_ids(df.select(F.col(supplier).alias("entity")), "entity", "_sid")
    s = s.crossJoin(F.broadcast(n_b)).select((F.col("_sid") + F.col("_nb")).alias("id"), "entity")
    return b.withColumn("node_type", F.lit(BUYER)).unionByName(s.withColumn("node_type", F.lit(SUPPLIER)))


def node_id_join(df: DataFrame, nodes: DataFrame, buyer: str = "acheteur_id",
                 supplier: str = "titulaire_id") -> DataFrame:
    """Attach ``src``/``dst`` node ids (two equi joins to the node table)."""
    nb = nodes.filter(F.col("node_type") == BUYER).select(F.col("entity").alias(buyer), F.col("id").alias("src"))
    ns = nodes.filter(F.col("node_type") == SUPPLIER).select(F.col("entity").alias(supplier),
                                                              F.col("id").alias("dst"))
    return df.join(nb, buyer).join(ns, supplier)


def graph_edges(df: DataFrame, nodes: DataFrame, features: Sequence[str] = (), key: str = "uid",
                buyer: str = "acheteur_id", supplier: str = "titulaire_id") -> DataFrame:
    j = node_id_join(df.select(key, buyer, supplier, *features), nodes, buyer, supplier)
    cols = [key, "src", "dst"]
    if features:
        cols.append(F.array(*[F.col(c).cast("double") for c in features]).alias("features"))
    return j.select(*cols)


def build_graph(df: DataFrame, features: Sequence[str] = (), key: str = "uid", buyer: str = "acheteur_id",
                supplier: str = "titulaire_id", materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges), each written once to the shared folder.
    Dense ids come from a range-partitioned numbering (non-deterministic
    partition ids), so every later consumer must read the same materialized
    copy rather than re-derive it."""
    nodes = graph_nodes(df, buyer, supplier)
    if materialize:
        nodes = stage(nodes, "nodes")
    edges = graph_edges(df, nodes, features, key, buyer, supplier)
    if materialize:
        edges = stage(edges, "edges")
    return nodes, edges


def node_features(df: DataFrame, features: Sequence[str], numeric: Sequence[str],
                  buyer: str = "acheteur_id", supplier: str = "titulaire_id") -> DataFrame:
    """Per entity and role: mean of every feature, sample std (null → 0) of
    the numeric ones, contract count, distinct partners, contracts/partner."""
    def role(entity: str, partner: str, node_type: int) -> DataFrame:
        aggs = [F.avg(c).alias(f"mean_{c}") for c in features]
        aggs += [F.coalesce(F.stddev_samp(c), dbl(0)).alias(f"std_{c}") for c in numeric]
        aggs += [F.count(F.lit(1)).alias("num_contracts"), F.count_distinct(partner).alias("num_partners")]
        g = df.filter(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("entity")).agg(*aggs)
        return g.withColumn("node_type", F.lit(node_type)).withColumn(
            "contracts_per_partner", F.col("num_contracts") / F.greatest(F.col("num_partners"), F.lit(1)))
    return role(buyer, supplier, BUYER).unionByName(role(supplier, buyer, SUPPLIER))


def contract_payload(df: DataFrame, cols: Sequence[str], key: str = "uid") -> DataFrame:
    return df.select(key, *[c for c in cols if c in df.columns])


# ------------------------------------------------------------ message passing
def to_long(state: DataFrame, vec: str = "h") -> DataFrame:
    return state.select("id", F.posexplode(vec).alias("pos", "value"))


def message_pass(edges: DataFrame, state_long: DataFrame, rounds: int = 3, undirected: bool = False,
                 checkpoint: bool = True) -> DataFrame:
    """h_{k+1}(v) = h_k(v) + Σ_{edges u→v} h_k(u), element-wise, ``rounds``
    times (sum aggregation, one message per edge/contract).  Directed by
    default (buyers → suppliers), so buyers keep their state.

    Edges are counted once per pair of nodes, and the state of a node is one
    row, a map by position; ``state_long`` and the result are (id, pos,
    value)."""
    e = edges.select("src", "dst")
    if undirected:
        e = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = e.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("_w"))
    positions = sorted(r[0] for r in state_long.select("pos").distinct().collect())     # of a feature vector
    at = {p: f"_p{k}" for k, p in enumerate(positions)}
    cols = list(at.values())
    h = state_long.groupBy("id").agg(*[F.sum(F.when(F.col("pos") == p, F.col("value"))).alias(c) for p, c in at.items()])
    if checkpoint:
        e = cut_lineage(e)
    for _ in range(rounds):
        msg = e.join(h.withColumnRenamed("id", "src"), "src") \
               .groupBy(F.col("dst").alias("id")).agg(*[F.sum(F.col(c) * F.col("_w")).alias(f"_m{c}") for c in cols])
        h = h.join(msg, "id", "left").select("id", *[(F.col(c) + F.coalesce(F.col(f"_m{c}"), dbl(0))).alias(c) for c in cols])
        if checkpoint:
            h = cut_lineage(h)
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("pos"), F.col(c).alias("value")) for p, c in at.items()]))
    return h.select("id", pairs.alias("_s")).select("id", "_s.pos", "_s.value").filter(F.col("value").isNotNull())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of undirected ``edges`` (a, b): the
    smallest node of the component.  Each round takes the smallest label of a
    node's neighbours and then the label of that label; a round is written to
    the shared folder, and the last is the one that changes nothing."""
    both = cut_lineage(edges.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("next"))).distinct())
    labels = cut_lineage(both.groupBy("node").agg(F.least(F.min("next"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("next"), F.col("label").alias("_l")), "next").groupBy("node").agg(F.min("_l").alias("_l"))
        moved = labels.join(near, "node").select("node", F.least("label", "_l").alias("_to"), F.col("label").alias("_old"))
        jump = moved.join(labels.select(F.col("node").alias("_to"), F.col("label").alias("_f")), "_to") \
                    .select("node", F.least("_to", "_f").alias("label"), "_old")
        done = cut_lineage(jump)
        labels = done.select("node", "label")
        if done.filter("label != _old").isEmpty():
            return labels


# ------------------------------------------------------------ scores
def threshold_flag(scores: DataFrame, col: str, p: float, written: bool = False) -> DataFrame:
    """threshold = exact percentile(col, 100 − p); flag = value > threshold.
    NaN/null scores are excluded from the percentile and never flagged.

    The percentile takes two passes and the flag a third.  A score that comes
    out of a sum may end in another digit each time it is made, so scores are
    written first, unless the caller says that they are ``written`` values or
    row-by-row functions of such."""
    if not written:
        scores = stage(scores, "scores")
    x = F.col(col)
    valid = scores.filter(x.isNotNull() & ~F.isnan(x))
    thr = exact_quantile_row(valid, col, [(100.0 - p) / 100.0], ["threshold"])
    out = scores.crossJoin(F.broadcast(thr))   # one row
    flag = F.coalesce(x.isNotNull() & ~F.isnan(x) & (x > F.col("threshold")), F.lit(False))
    return out.withColumn("is_anomaly", flag)


def score_diagnostics(scores: DataFrame, col: str) -> DataFrame:
    x = F.col(col)
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    fx = F.when(finite, x)
    return scores.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.isnan(x)).alias("n_nan"),
        F.count_if(x.isNotNull() & (F.abs(x) == F.lit(float("inf")))).alias("n_inf"),
        F.count_if(finite).alias("n_finite"), F.min(fx).alias("min"), F.max(fx).alias("max"),
        F.avg(fx).alias("mean"), F.stddev_pop(fx).alias("std"))


def neighbor_nodes(edges: DataFrame, flagged: DataFrame) -> DataFrame:
    """Flagged node ids plus their 1-hop neighbours (both directions)."""
    f = flagged.select("id").distinct()
    out_n = edges.join(f.withColumnRenamed("id", "src"), "src").select(F.col("dst").alias("id"))
    in_n = edges.join(f.withColumnRenamed("id", "dst"), "dst").select(F.col("src").alias("id"))
    return f.unionByName(out_n).unionByName(in_n).distinct()


def anomalous_subgraph(edges: DataFrame, flagged: DataFrame) -> DataFrame:
    """One row: nodes in the flagged 1-hop neighbourhood and distinct
    undirected edges with both ends inside it."""
    nodes = cut_lineage(neighbor_nodes(edges, flagged))   # read three times below
    inside = edges.join(nodes.withColumnRenamed("id", "src"), "src", "left_semi") \
                  .join(nodes.withColumnRenamed("id", "dst"), "dst", "left_semi")
    und = inside.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    return nodes.agg(F.count(F.lit(1)).alias("n_nodes")).crossJoin(und.agg(F.count(F.lit(1)).alias("n_edges")))


def propagate_truth(df: DataFrame, label: str, buyer: str = "acheteur_id",
                    supplier: str = "titulaire_id") -> DataFrame:
    """An entity is truly anomalous when any of its contracts is."""
    lab = F.max(F.col(label).cast("int")).alias("is_true_anomaly")
    b = df.groupBy(F.col(buyer).alias("entity")).agg(lab).withColumn("node_type", F.lit(BUYER))
    s = df.groupBy(F.col(supplier).alias("entity")).agg(lab).withColumn("node_type", F.lit(SUPPLIER))
    return b.unionByName(s)
