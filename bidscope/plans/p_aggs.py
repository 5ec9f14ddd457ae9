"""§2.4 aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.functions.columns import cpv_level
from bidscope.operators import flags as FL
from bidscope.operators import stats as ST
from bidscope.plans.oracle import cpv_level_sql, with_contracts
from bidscope.plans.registry import plan
from bidscope.session import stage_small as stage
from bidscope.sources.tables import contracts, contracts_staged

NUMS = ["montant", "dureeMois", "offresRecues", "tauxAvance"]


@plan("value_counts", with_contracts(
    "SELECT procedure, count(*) AS n FROM contracts WHERE procedure IS NOT NULL GROUP BY 1"), "2.4")
def value_counts(spark, sf):
    return ST.value_counts(contracts(spark, sf), "procedure")


@plan("value_shares", with_contracts("""
SELECT formePrix, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM (
  SELECT formePrix, count(*) AS n FROM contracts WHERE formePrix IS NOT NULL GROUP BY 1) t"""), "2.4")
def value_shares(spark, sf):
    return ST.value_shares(contracts(spark, sf), "formePrix")


SHARE_CTES = """f AS (SELECT formePrix, procedure IN ('Appel d''offres ouvert', 'Appel d''offres restreint')
                  AND coalesce(offresRecues = 1, false) AS flag FROM contracts WHERE formePrix IS NOT NULL),
  sa AS (SELECT formePrix, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS s FROM f
         WHERE flag GROUP BY 1),
  sb AS (SELECT formePrix, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS s FROM f
         WHERE NOT flag GROUP BY 1)"""


@plan("share_compare", with_contracts("""
SELECT coalesce(sa.formePrix, sb.formePrix) AS formePrix, coalesce(sa.s, CAST(0 AS DOUBLE)) AS share_flagged,
       coalesce(sb.s, CAST(0 AS DOUBLE)) AS share_normal FROM sa FULL JOIN sb ON sa.formePrix = sb.formePrix""",
    SHARE_CTES), "2.4")
def share_compare(spark, sf):
    c = contracts(spark, sf)
    return ST.share_compare(c, "formePrix", F.coalesce(FL.single_bid(), F.lit(False)))


@plan("group_size", with_contracts("""
SELECT acheteur_id, titulaire_id, count(*) AS n FROM contracts
WHERE acheteur_id IS NOT NULL AND titulaire_id IS NOT NULL GROUP BY 1, 2"""), "2.4")
def group_size(spark, sf):
    return ST.group_size(contracts(spark, sf), ["acheteur_id", "titulaire_id"])


@plan("group_mean_std_count", with_contracts("""
SELECT cpv3, round(avg(montant), 4) AS mean, round(stddev_samp(montant), 4) AS std, count(*) AS n FROM (
  SELECT """ + cpv_level_sql("codeCPV", 3) + """ AS cpv3, montant FROM contracts) t
WHERE montant IS NOT NULL AND cpv3 IS NOT NULL GROUP BY 1 HAVING count(*) >= 200"""), "2.4")
def group_mean_std_count(spark, sf):
    c = contracts(spark, sf).select(cpv_level("codeCPV", 3).alias("cpv3"), "montant")
    out = ST.group_mean_std_count(c, "cpv3", "montant", 200)
    return out.select("cpv3", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "n")


@plan("pair_totals", with_contracts("""
SELECT acheteur_id, titulaire_id,
       CAST(coalesce(sum(CAST(montant AS DECIMAL(24, 4))), 0) AS DOUBLE) AS total,
       count(montant) AS n_amounts FROM contracts
WHERE acheteur_id IS NOT NULL AND titulaire_id IS NOT NULL GROUP BY 1, 2"""), "2.4")
def pair_totals(spark, sf):
    # amounts carry at most 4 decimals: an exact decimal sum makes the
    # reported total independent of summation order
    c = contracts(spark, sf).withColumn("montant", F.col("montant").cast("decimal(24,4)"))
    pt = FL.pair_totals(c, FL.RuleParams())
    return pt.select("acheteur_id", "titulaire_id", F.col("_sum").cast("double").alias("total"),
                     F.col("_cnt").alias("n_amounts"))


@plan("group_median_order", with_contracts("""
SELECT categorie, round(quantile_cont(montant, 0.5), 6) AS median FROM contracts
WHERE montant IS NOT NULL GROUP BY 1"""), "2.4")
def group_median_order(spark, sf):
    med = ST.group_medians(contracts(spark, sf), "categorie", "montant")
    return med.select("categorie", F.round("median", 6).alias("median")).orderBy("median")


@plan("distinct_count", with_contracts("""
SELECT count(DISTINCT uid) AS n_uid, count(DISTINCT acheteur_id) AS n_acheteur_id,
       count(DISTINCT titulaire_id) AS n_titulaire_id, count(DISTINCT codeCPV) AS n_codeCPV FROM contracts"""), "2.4")
def distinct_count(spark, sf):
    return ST.distinct_count(contracts(spark, sf), ["uid", "acheteur_id", "titulaire_id", "codeCPV"])


@plan("distinct_rows", with_contracts("SELECT DISTINCT acheteur_id FROM contracts WHERE acheteur_id IS NOT NULL"),
      "2.4")
def distinct_rows(spark, sf):
    return contracts(spark, sf).select("acheteur_id").filter(F.col("acheteur_id").isNotNull()).distinct()


PROBS = [0.25, 0.5, 0.75, 0.95, 0.99]


@plan("percentile_exact", with_contracts("SELECT " + ", ".join(
    f"round(quantile_cont(montant, {p}), 6) AS p{str(p).replace('.', '_')}" for p in PROBS) + " FROM contracts"),
    "2.4")
def percentile_exact(spark, sf):
    q = ST.percentiles(contracts(spark, sf), "montant", PROBS)
    return q.select(*[F.round(c, 6).alias(c) for c in q.columns])


@plan("median_exact", with_contracts(
    "SELECT round(median(montant), 6) AS median_montant, round(median(dureeMois), 6) AS median_duree FROM contracts"),
    "2.4")
def median_exact(spark, sf):
    from bidscope.operators.quantiles import exact_quantile_row
    c = contracts_staged(spark, sf, ["montant", "dureeMois"])        # two passes for each column
    a = exact_quantile_row(c, "montant", [0.5], ["median_montant"])
    b = exact_quantile_row(c, "dureeMois", [0.5], ["median_duree"])
    return a.crossJoin(b).select(F.round("median_montant", 6).alias("median_montant"),
                                 F.round("median_duree", 6).alias("median_duree"))


@plan("mode_share", with_contracts("""
SELECT acheteur_region, top_value, CAST(n AS DOUBLE) / CAST(tot AS DOUBLE) AS top_share, diversity FROM (
  SELECT acheteur_region, categorie AS top_value, n, sum(n) OVER (PARTITION BY acheteur_region) AS tot,
         count(*) OVER (PARTITION BY acheteur_region) AS diversity,
         row_number() OVER (PARTITION BY acheteur_region ORDER BY n DESC, categorie) AS rk
  FROM (SELECT acheteur_region, categorie, count(*) AS n FROM contracts
        WHERE acheteur_region IS NOT NULL AND categorie IS NOT NULL GROUP BY 1, 2) a) t WHERE rk = 1"""), "2.4")
def mode_share(spark, sf):
    return ST.mode_share(contracts(spark, sf), "acheteur_region", "categorie")


@plan("crosstab_normalized", with_contracts("""
SELECT procedure, categorie, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY procedure) AS DOUBLE) AS share FROM (
  SELECT procedure, categorie, count(*) AS n FROM contracts GROUP BY 1, 2) t"""), "2.4")
def crosstab_normalized(spark, sf):
    return ST.crosstab_normalized(contracts(spark, sf), "procedure", "categorie")


@plan("describe_table", with_contracts("""
SELECT count(montant) AS count, round(avg(montant), 4) AS mean, round(stddev_samp(montant), 4) AS std,
       min(montant) AS min, round(quantile_cont(montant, 0.25), 6) AS q25, round(quantile_cont(montant, 0.5), 6) AS q50,
       round(quantile_cont(montant, 0.75), 6) AS q75, max(montant) AS max FROM contracts"""), "2.4")
def describe_table(spark, sf):
    d = ST.describe_table(contracts(spark, sf), "montant")
    return d.select("count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min",
                    F.round("q25", 6).alias("q25"), F.round("q50", 6).alias("q50"), F.round("q75", 6).alias("q75"),
                    "max")


@plan("null_profile", with_contracts(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM contracts"
    for c in ["montant", "dureeMois", "offresRecues", "tauxAvance", "sousTraitanceDeclaree", "idAccordCadre",
              "codeCPV", "dateNotification"])), "2.4")
def null_profile(spark, sf):
    cols = ["montant", "dureeMois", "offresRecues", "tauxAvance", "sousTraitanceDeclaree", "idAccordCadre",
            "codeCPV", "dateNotification"]
    return ST.null_profile(contracts(spark, sf), cols)


@plan("corr_matrix", with_contracts(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM contracts"
    for i, a in enumerate(NUMS) for b in NUMS[i + 1:])), "2.4")
def corr_matrix(spark, sf):
    out = ST.corr_pairs(contracts(spark, sf), NUMS)
    return out.select("col_a", "col_b", F.round("corr", 6).alias("corr"))


@plan("corr_target", with_contracts("""
SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, montant) AS corr FROM contracts" for c in
    ["dureeMois", "offresRecues", "tauxAvance", "sousTraitanceDeclaree", "origineFrance", "marcheInnovant"]) +
    ") t WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 3"), "2.4")
def corr_target(spark, sf):
    feats = ["dureeMois", "offresRecues", "tauxAvance", "sousTraitanceDeclaree", "origineFrance", "marcheInnovant"]
    out = ST.corr_target(contracts(spark, sf), feats, "montant", 3)
    return out.select("feature", F.round("corr", 6).alias("corr"), F.round("abs_corr", 6).alias("abs_corr"))


@plan("histogram_log", with_contracts("""
SELECT CAST(CASE WHEN log10(montant) < 0 THEN 0 WHEN log10(montant) >= 10 THEN 51
            ELSE floor(CAST(50 AS DOUBLE) * (log10(montant) - 0) / (10 - 0)) + 1 END AS BIGINT) AS bin,
       count(*) AS n FROM contracts WHERE montant > 0 GROUP BY 1"""), "2.4")
def histogram_log(spark, sf):
    return ST.histogram_log(contracts(spark, sf), "montant", 0.0, 10.0, 50)


ABOVE = [1e6, 5e6, 1e7]
BELOW = [10.0, 1000.0, 10000.0, 25000.0, 40000.0]


@plan("threshold_tail_counts", with_contracts("SELECT " + ", ".join(
    [f"count(*) FILTER (WHERE montant > {t}) AS above_{int(t)}" for t in ABOVE]
    + [f"count(*) FILTER (WHERE montant < {t}) AS below_{int(t)}" for t in BELOW]) + " FROM contracts"), "2.4")
def threshold_tail_counts(spark, sf):
    return ST.threshold_tail_counts(contracts(spark, sf), "montant", ABOVE, BELOW)


PROFILE_SQL = """prof AS (
  SELECT g.cluster, g.size, round(CAST(g.size AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(t.tot AS DOUBLE), 6) AS pct_total,
         m.top_cpv, round(m.top_cpv_pct, 6) AS top_cpv_pct, m.cpv_diversity,
         round(g.mean_amount, 4) AS mean_amount, round(q.median_amount, 6) AS median_amount,
         round(g.std_amount, 4) AS std_amount, round(g.mean_duration, 6) AS mean_duration,
         round(q.median_duration, 6) AS median_duration,
         round(CASE WHEN q.median_duration > 0 THEN q.median_amount / q.median_duration
                    ELSE q.median_amount END, 4) AS euro_per_month
  FROM (SELECT cluster, count(*) AS size, avg(montant) AS mean_amount, stddev_samp(montant) AS std_amount,
               avg(dureeMois) AS mean_duration FROM cl GROUP BY 1 HAVING count(*) >= 20) g
  CROSS JOIN (SELECT count(*) AS tot FROM cl) t
  LEFT JOIN (SELECT cluster, quantile_cont(montant, 0.5) AS median_amount,
                    quantile_cont(dureeMois, 0.5) AS median_duration FROM cl GROUP BY 1) q USING (cluster)
  LEFT JOIN (SELECT cluster, cpv4 AS top_cpv, CAST(n AS DOUBLE) / CAST(tot AS DOUBLE) * CAST(100 AS DOUBLE) AS top_cpv_pct,
                    diversity AS cpv_diversity FROM (
               SELECT cluster, cpv4, n, sum(n) OVER (PARTITION BY cluster) AS tot,
                      count(*) OVER (PARTITION BY cluster) AS diversity,
                      row_number() OVER (PARTITION BY cluster ORDER BY n DESC, cpv4) AS rk
               FROM (SELECT cluster, cpv4, count(*) AS n FROM cl GROUP BY 1, 2) a) b WHERE rk = 1) m USING (cluster))"""
CLUSTER_CTE = ("cl AS (SELECT " + cpv_level_sql("codeCPV", 2) + " AS cluster, " + cpv_level_sql("codeCPV", 4)
               + " AS cpv4, montant, dureeMois FROM contracts)")


def _profile(spark, sf):
    # every figure of the profile is a pass of its own
    c = stage(contracts(spark, sf).select(cpv_level("codeCPV", 2).alias("cluster"), cpv_level("codeCPV", 4).alias("cpv4"),
                                          "montant", "dureeMois"), "profile")
    p = ST.cluster_profile(c, "cluster", "cpv4", "montant", "dureeMois", 20)
    r = F.round
    return p.select("cluster", "size", r("pct_total", 6).alias("pct_total"), "top_cpv",
                    r("top_cpv_pct", 6).alias("top_cpv_pct"), "cpv_diversity", r("mean_amount", 4).alias("mean_amount"),
                    r("median_amount", 6).alias("median_amount"), r("std_amount", 4).alias("std_amount"),
                    r("mean_duration", 6).alias("mean_duration"), r("median_duration", 6).alias("median_duration"),
                    r("euro_per_month", 4).alias("euro_per_month"))


@plan("cluster_profile", with_contracts("SELECT * FROM prof", CLUSTER_CTE + ",\n" + PROFILE_SQL), "2.4")
def cluster_profile(spark, sf):
    return _profile(spark, sf)


@plan("profile_by_top_cpv", with_contracts("""
SELECT substr(top_cpv, 1, 2) AS top_division, count(*) AS n_clusters, CAST(sum(size) AS BIGINT) AS total_size
FROM prof GROUP BY 1""", CLUSTER_CTE + ",\n" + PROFILE_SQL), "2.4")
def profile_by_top_cpv(spark, sf):
    p = _profile(spark, sf)
    return p.groupBy(F.substring("top_cpv", 1, 2).alias("top_division")).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.sum("size").alias("total_size"))
