"""§2.12 graph plans (and the §2.3 node/neighbour joins)."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from bidscope.functions.columns import cpv_level
from bidscope.operators import flags as FL
from bidscope.operators import graph as G
from bidscope.operators import states as S
from bidscope.plans.oracle import cpv_level_sql, with_contracts
from bidscope.plans.registry import plan
from bidscope.session import scratch_path, stage_small as stage
from bidscope.sources.tables import contracts, contracts_staged

FEATS = ["montant", "dureeMois", "offresRecues"]


def _dp(col: str) -> int:
    """Decimals kept in checked output: amounts are ~1e6, so summation-order
    noise reaches the 1e-10 digit; durations and bids are small."""
    return 2 if col == "montant" else 6

NODES = """nodes AS (
  SELECT CAST(row_number() OVER (ORDER BY acheteur_id) - 1 AS BIGINT) AS id, acheteur_id AS entity, 0 AS node_type
  FROM (SELECT DISTINCT acheteur_id FROM contracts WHERE acheteur_id IS NOT NULL) b
  UNION ALL
  SELECT CAST((SELECT count(DISTINCT acheteur_id) FROM contracts) + row_number() OVER (ORDER BY titulaire_id) - 1
              AS BIGINT), titulaire_id, 1
  FROM (SELECT DISTINCT titulaire_id FROM contracts WHERE titulaire_id IS NOT NULL) s),
  edges AS (SELECT c.uid, b.id AS src, s.id AS dst FROM contracts c
            JOIN nodes b ON b.node_type = 0 AND b.entity = c.acheteur_id
            JOIN nodes s ON s.node_type = 1 AND s.entity = c.titulaire_id)"""
NF = """nf AS (SELECT acheteur_id AS entity, 0 AS node_type, count(*) AS nc, count(DISTINCT titulaire_id) AS np
              FROM contracts WHERE acheteur_id IS NOT NULL GROUP BY 1
              UNION ALL SELECT titulaire_id, 1, count(*), count(DISTINCT acheteur_id) FROM contracts
              WHERE titulaire_id IS NOT NULL GROUP BY 1)"""
EDGE_SCORE = """ez AS (SELECT c.uid, abs(c.montant - s.m) / s.sd AS z FROM contracts c JOIN (
                 SELECT categorie, avg(montant) AS m, stddev_samp(montant) AS sd FROM contracts GROUP BY 1) s
               USING (categorie))"""
NODE_SCORE = """nz AS (SELECT n.id, nf.entity, nf.node_type, nf.nc, nf.np,
                      CAST(nf.nc AS DOUBLE) / CAST(greatest(nf.np, 1) AS DOUBLE) AS cpp,
                      pow((ln(1 + nf.nc) - st.m) / st.sd, 2) AS err
               FROM nf JOIN nodes n USING (entity, node_type) JOIN (
                 SELECT node_type, avg(ln(1 + nc)) AS m, stddev_pop(ln(1 + nc)) AS sd FROM nf GROUP BY 1) st
               USING (node_type)),
  nthr AS (SELECT quantile_cont(err, 0.95) AS thr FROM nz)"""


def _c(spark, sf):
    return contracts(spark, sf)


def _graph(spark, sf, columns=()):
    c = contracts_staged(spark, sf, ["uid", "acheteur_id", "titulaire_id", *columns])
    nodes, edges = G.build_graph(c)
    return c, nodes, edges


@plan("graph_nodes", with_contracts("SELECT * FROM nodes", NODES), "2.12")
def graph_nodes(spark, sf):
    return _graph(spark, sf)[1]


@plan("graph_edges", with_contracts("SELECT * FROM edges", NODES), "2.12")
def graph_edges(spark, sf):
    return _graph(spark, sf)[2]


@plan("node_id_join", with_contracts(
    "SELECT e.uid, e.src, e.dst, c.acheteur_id, c.titulaire_id FROM edges e JOIN contracts c USING (uid)", NODES),
    "2.3")
def node_id_join(spark, sf):
    c, nodes, _ = _graph(spark, sf)
    return G.node_id_join(c.select("uid", "acheteur_id", "titulaire_id"), nodes) \
            .select("uid", "src", "dst", "acheteur_id", "titulaire_id")


@plan("node_features", with_contracts(" UNION ALL ".join(
    f"SELECT {e} AS entity, " + ", ".join(f"round(avg({f}), {_dp(f)}) AS mean_{f}" for f in FEATS) + ", "
    + ", ".join(f"round(coalesce(stddev_samp({f}), 0), {_dp(f)}) AS std_{f}" for f in FEATS)
    + f", count(*) AS num_contracts, count(DISTINCT {p}) AS num_partners, {t} AS node_type, "
    f"CAST(count(*) AS DOUBLE) / CAST(greatest(count(DISTINCT {p}), 1) AS DOUBLE) AS contracts_per_partner "
    f"FROM contracts WHERE {e} IS NOT NULL GROUP BY 1"
    for e, p, t in (("acheteur_id", "titulaire_id", 0), ("titulaire_id", "acheteur_id", 1)))), "2.12")
def node_features(spark, sf):
    nf = G.node_features(_c(spark, sf), FEATS, FEATS)
    r = [F.round(c, _dp(c.split("_", 1)[1])).alias(c) for c in nf.columns if c.startswith(("mean_", "std_"))]
    return nf.select("entity", *r, "num_contracts", "num_partners", "node_type", "contracts_per_partner")


@plan("contract_payload", with_contracts(
    "SELECT uid, acheteur_id, titulaire_id, montant, procedure, dateNotification FROM contracts"), "2.12")
def contract_payload(spark, sf):
    return G.contract_payload(_c(spark, sf), ["acheteur_id", "titulaire_id", "montant", "procedure",
                                              "dateNotification", "not_a_column"])


def _h_sql(prev: str, cur: str) -> str:
    return (f"{cur} AS (SELECT h.id, h.pos, h.value + coalesce(m.s, 0) AS value FROM {prev} h LEFT JOIN ("
            f"SELECT e.dst AS id, p.pos, sum(p.value) AS s FROM edges e JOIN {prev} p ON e.src = p.id GROUP BY 1, 2) m "
            f"USING (id, pos))")


@plan("message_pass_sum", with_contracts("SELECT id, pos, round(value, 6) AS value FROM h3", ",\n  ".join([
    NODES, NF,
    """h0 AS (SELECT n.id, 0 AS pos, ln(1 + nf.nc) AS value FROM nf JOIN nodes n USING (entity, node_type)
          UNION ALL SELECT n.id, 1, ln(1 + nf.np) FROM nf JOIN nodes n USING (entity, node_type))""",
    _h_sql("h0", "h1"), _h_sql("h1", "h2"), _h_sql("h2", "h3")])), "2.12")
def message_pass_sum(spark, sf):
    """States of nodes only, added up."""
    c, nodes, edges = _graph(spark, sf)
    nf = G.node_features(c, [], []).join(nodes, ["entity", "node_type"])
    h0 = nf.select("id", F.array(F.log1p("num_contracts"), F.log1p("num_partners")).alias("h"))
    out = G.message_pass(edges, G.to_long(h0), rounds=3)
    return out.select("id", "pos", F.round("value", 6).alias("value"))


def _round_sql(k: int, n: int, e: int) -> str:
    """Round k from node states of width n and edge states of width e."""
    width = n + e + 2 * n
    return f"""e{k} AS (SELECT e.uid, e.src, e.dst, list_concat(list_concat(e.h, s.h), d.h) AS h, s.h AS sent
          FROM e{k - 1} e JOIN n{k - 1} s ON e.src = s.id JOIN n{k - 1} d ON e.dst = d.id),
  m{k} AS (SELECT dst AS id, list(v ORDER BY pos) AS got FROM (
             SELECT dst, pos, sum(v) AS v FROM (
               SELECT dst, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM (SELECT dst, list_concat(sent, h) AS x FROM e{k}) a) b
             GROUP BY 1, 2) c GROUP BY 1),
  n{k} AS (SELECT n.id, list_concat(n.h, coalesce(m.got, [0.0::DOUBLE for i in range({width})])) AS h FROM n{k - 1} n LEFT JOIN m{k} m USING (id))"""


@plan("message_pass", with_contracts("""
SELECT id, CAST(pos - 1 AS INTEGER) AS pos, round(sign(v) * ln(1 + abs(v)), 6) AS value FROM (
  SELECT id, unnest(h) AS v, generate_subscripts(h, 1) AS pos FROM n3) t""", ",\n  ".join([
    NODES, NF,
    "n0 AS (SELECT n.id, [ln(1 + nf.nc)] AS h FROM nf JOIN nodes n USING (entity, node_type))",
    "e0 AS (SELECT e.uid, e.src, e.dst, [ln(1 + coalesce(c.montant, 0))] AS h FROM edges e JOIN contracts c USING (uid))",
    _round_sql(1, 1, 1), _round_sql(2, 5, 3), _round_sql(3, 23, 13)])), "2.12")
def message_pass(spark, sf):
    """Three rounds of states of contracts and entities, own states kept
    beside the messages, not projected; by sign and logarithm."""
    c, nodes, edges = _graph(spark, sf, ["montant"])
    counts = G.node_features(c, [], []).join(nodes, ["entity", "node_type"])
    start = counts.select("id", F.array(F.log1p(F.col("num_contracts").cast("double"))).alias("h"))
    amounts = c.select("uid", F.array(F.log1p(F.coalesce("montant", F.lit(0.0)))).alias("h"))
    out = S.state_rounds(start, edges.select("uid", "src", "dst").join(amounts, "uid"))[0]
    value = F.signum("value") * F.log1p(F.abs(F.col("value")))
    return out.select("id", F.posexplode("h").alias("pos", "value")).select("id", "pos", F.round(value, 6).alias("value"))


def _edge_scores(c):
    """Functions of a row and of written statistics: the same at every pass."""
    st = stage(c.groupBy("categorie").agg(F.avg("montant").alias("_m"), F.stddev_samp("montant").alias("_sd")), "category-stats")
    return c.join(st, "categorie").withColumn("z", F.abs(F.col("montant") - F.col("_m")) / F.col("_sd"))


def _node_scores(c, nodes):
    nf = G.node_features(c, [], []).join(nodes, ["entity", "node_type"])
    x = F.log1p("num_contracts")
    st = nf.groupBy("node_type").agg(F.avg(x).alias("_m"), F.stddev_pop(x).alias("_sd"))
    return nf.join(st, "node_type").withColumn("err", F.pow((x - F.col("_m")) / F.col("_sd"), 2))


@plan("threshold_flag", with_contracts("""
SELECT uid, round(z, 6) AS error, round(t.thr, 6) AS threshold, coalesce(z > t.thr, false) AS is_anomaly
FROM ez, (SELECT quantile_cont(z, 0.95) AS thr FROM ez WHERE z IS NOT NULL AND NOT isnan(z)) t""", EDGE_SCORE),
    "2.12")
def threshold_flag(spark, sf):
    c = contracts_staged(spark, sf, ["uid", "categorie", "montant"])
    s = G.threshold_flag(_edge_scores(c), "z", 5.0, written=True)
    return s.select("uid", F.round("z", 6).alias("error"), F.round("threshold", 6).alias("threshold"), "is_anomaly")


@plan("score_diagnostics", with_contracts("""
SELECT count(*) AS n, count(*) FILTER (WHERE isnan(z)) AS n_nan, count(*) FILTER (WHERE isinf(z)) AS n_inf,
       count(*) FILTER (WHERE isfinite(z)) AS n_finite, round(min(z) FILTER (WHERE isfinite(z)), 6) AS min,
       round(max(z) FILTER (WHERE isfinite(z)), 6) AS max, round(avg(z) FILTER (WHERE isfinite(z)), 6) AS mean,
       round(stddev_pop(z) FILTER (WHERE isfinite(z)), 6) AS std FROM ez""", EDGE_SCORE), "2.12")
def score_diagnostics(spark, sf):
    d = G.score_diagnostics(_edge_scores(contracts_staged(spark, sf, ["categorie", "montant"])), "z")
    return d.select("n", "n_nan", "n_inf", "n_finite", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")])


NODE_RESULTS_SQL = with_contracts("""
SELECT entity, node_type, round(err, 6) AS error, coalesce(err > nthr.thr, false) AS is_anomaly, nc AS num_contracts,
       np AS num_partners, cpp AS contracts_per_partner,
       round((CAST(nc AS DOUBLE) + CAST(np AS DOUBLE) + cpp) / 3, 6) AS mean_feature_value,
       round(sqrt((pow(nc - (nc + np + cpp) / 3, 2) + pow(np - (nc + np + cpp) / 3, 2)
                   + pow(cpp - (nc + np + cpp) / 3, 2)) / 3), 6) AS std_feature_value
FROM nz, nthr""", ",\n  ".join([NODES, NF, NODE_SCORE]))


def _node_results(spark, sf):
    c, nodes, edges = _graph(spark, sf)
    s = G.threshold_flag(_node_scores(c, nodes), "err", 5.0)
    a, b, cc = (F.col("num_contracts").cast("double"), F.col("num_partners").cast("double"),
                F.col("contracts_per_partner"))
    m = (a + b + cc) / F.lit(3.0)
    sd = F.sqrt((F.pow(a - m, 2) + F.pow(b - m, 2) + F.pow(cc - m, 2)) / F.lit(3.0))
    return s.select("id", "entity", "node_type", F.round("err", 6).alias("error"), "is_anomaly", "num_contracts",
                    "num_partners", "contracts_per_partner", F.round(m, 6).alias("mean_feature_value"),
                    F.round(sd, 6).alias("std_feature_value")), edges


@plan("node_results", NODE_RESULTS_SQL, "2.12")
def node_results(spark, sf):
    return _node_results(spark, sf)[0].drop("id").orderBy(F.desc("error"), "entity")


@plan("edge_results", with_contracts(f"""
SELECT c.uid, round(z, 6) AS error, coalesce(z > t.thr, false) AS is_anomaly, c.acheteur_id, c.titulaire_id,
       c.montant, {cpv_level_sql('c.codeCPV', 3)} AS codeCPV_3, c.procedure, c.dateNotification
FROM contracts c JOIN ez USING (uid), (SELECT quantile_cont(z, 0.95) AS thr FROM ez) t""", EDGE_SCORE), "2.12")
def edge_results(spark, sf):
    c = contracts_staged(spark, sf, ["uid", "categorie", "acheteur_id", "titulaire_id", "montant", "codeCPV", "procedure",
                                     "dateNotification"])
    s = G.threshold_flag(_edge_scores(c), "z", 5.0, written=True)
    return s.select("uid", F.round("z", 6).alias("error"), "is_anomaly", "acheteur_id", "titulaire_id", "montant",
                    cpv_level("codeCPV", 3).alias("codeCPV_3"), "procedure", "dateNotification")


NEIGH_SQL = """fl AS (SELECT n.id FROM nz n, nthr WHERE n.err > nthr.thr),
  nb AS (SELECT id FROM fl UNION SELECT e.dst FROM edges e JOIN fl ON e.src = fl.id
         UNION SELECT e.src FROM edges e JOIN fl ON e.dst = fl.id)"""


def _neigh(spark, sf):
    res, edges = _node_results(spark, sf)
    return edges, res.filter("is_anomaly").select("id")


@plan("neighbor_join", with_contracts("SELECT id FROM nb", ",\n  ".join([NODES, NF, NODE_SCORE, NEIGH_SQL])), "2.3")
def neighbor_join(spark, sf):
    edges, flagged = _neigh(spark, sf)
    return G.neighbor_nodes(edges, flagged)


@plan("anomalous_subgraph", with_contracts("""
SELECT (SELECT count(*) FROM nb) AS n_nodes, (SELECT count(*) FROM (SELECT DISTINCT least(src, dst) AS a,
        greatest(src, dst) AS b FROM edges WHERE src IN (SELECT id FROM nb) AND dst IN (SELECT id FROM nb)) u)
        AS n_edges""", ",\n  ".join([NODES, NF, NODE_SCORE, NEIGH_SQL])), "2.12")
def anomalous_subgraph(spark, sf):
    edges, flagged = _neigh(spark, sf)
    return G.anomalous_subgraph(edges, flagged)


@plan("propagate_truth", with_contracts("""
SELECT acheteur_id AS entity, max(CAST(coalesce(procedure IN ('Appel d''offres ouvert', 'Appel d''offres restreint')
       AND offresRecues = 1, false) AS INTEGER)) AS is_true_anomaly, 0 AS node_type FROM contracts GROUP BY 1
UNION ALL
SELECT titulaire_id, max(CAST(coalesce(procedure IN ('Appel d''offres ouvert', 'Appel d''offres restreint')
       AND offresRecues = 1, false) AS INTEGER)), 1 FROM contracts GROUP BY 1"""), "2.12")
def propagate_truth(spark, sf):
    c = _c(spark, sf).withColumn("_lab", F.coalesce(FL.single_bid(), F.lit(False)))
    return G.propagate_truth(c, "_lab")


@plan("graph_store", with_contracts("SELECT * FROM edges", NODES), "2.1")
def graph_store(spark, sf):
    """Persist nodes and edges as Parquet in the shared folder; read edges back."""
    c, nodes, edges = _graph(spark, sf)
    base = scratch_path(spark, f"graph_{hashlib.md5(sf.encode()).hexdigest()[:8]}")
    nodes.write.mode("overwrite").parquet(base + "/nodes")
    edges.write.mode("overwrite").parquet(base + "/edges")
    return spark.read.parquet(base + "/edges")


@plan("sink_results", NODE_RESULTS_SQL, "2.1")
def sink_results(spark, sf):
    """Write the node result table to the shared folder and read it back."""
    res = _node_results(spark, sf)[0]
    path = scratch_path(spark, f"node_results_{hashlib.md5(sf.encode()).hexdigest()[:8]}")
    res = res.drop("id")
    res.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
