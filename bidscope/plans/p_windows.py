"""§2.5 windows and §2.6 sort / top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.functions.columns import cpv_level
from bidscope.operators import flags as FL
from bidscope.operators import stats as ST
from bidscope.plans.oracle import cpv_level_sql, with_contracts
from bidscope.plans.registry import plan
from bidscope.plans.p_flags import REPORT_SQL
from bidscope.sources.tables import contracts


@plan("partition_share", with_contracts("""
SELECT acheteur_id, categorie, titulaire_id, n, group_total, CAST(n AS DOUBLE) / CAST(group_total AS DOUBLE) AS share
FROM (SELECT acheteur_id, categorie, titulaire_id, count(*) AS n,
             CAST(sum(count(*)) OVER (PARTITION BY acheteur_id, categorie) AS BIGINT) AS group_total
      FROM contracts GROUP BY 1, 2, 3) t"""), "2.5")
def partition_share(spark, sf):
    out = ST.partition_share(contracts(spark, sf), ["acheteur_id", "categorie"], "titulaire_id")
    return out.withColumn("group_total", F.col("group_total").cast("bigint"))


@plan("topk_per_group", with_contracts(f"""
SELECT cl, cpv4, n, rank, CAST(n AS DOUBLE) / CAST(tot AS DOUBLE) AS share FROM (
  SELECT cl, cpv4, n, CAST(row_number() OVER (PARTITION BY cl ORDER BY n DESC, cpv4) AS INTEGER) AS rank,
         sum(n) OVER (PARTITION BY cl) AS tot
  FROM (SELECT {cpv_level_sql('codeCPV', 2)} AS cl, {cpv_level_sql('codeCPV', 4)} AS cpv4, count(*) AS n
        FROM contracts GROUP BY 1, 2) a) t WHERE rank <= 3"""), "2.5")
def topk_per_group(spark, sf):
    c = contracts(spark, sf).select(cpv_level("codeCPV", 2).alias("cl"), cpv_level("codeCPV", 4).alias("cpv4"))
    return ST.topk_per_group(c, "cl", "cpv4", 3)


HIST_SQL = """h AS (SELECT CAST(CASE WHEN log10(montant) < 0 THEN 0 WHEN log10(montant) >= 10 THEN 51
            ELSE floor(CAST(50 AS DOUBLE) * (log10(montant) - 0) / (10 - 0)) + 1 END AS BIGINT) AS bin,
       count(*) AS n FROM contracts WHERE montant > 0 GROUP BY 1)"""


@plan("rolling_mean", with_contracts("""
SELECT bin, n, round(avg(n) OVER (ORDER BY bin ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING), 9) AS rolling_mean
FROM h""", HIST_SQL), "2.5")
def rolling_mean(spark, sf):
    # the histogram has at most 52 rows: an unpartitioned window is bounded
    h = ST.histogram_log(contracts(spark, sf), "montant", 0.0, 10.0, 50)
    out = ST.rolling_mean(h, "bin", "n", 5, 4)
    return out.withColumn("rolling_mean", F.round("rolling_mean", 9))


@plan("cumulative_sum", with_contracts("""
SELECT categorie, n, CAST(sum(n) OVER (ORDER BY n DESC, categorie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                          AS BIGINT) AS cumsum
FROM (SELECT categorie, count(*) AS n FROM contracts WHERE categorie IS NOT NULL GROUP BY 1) t"""), "2.5")
def cumulative_sum(spark, sf):
    vc = ST.value_counts(contracts(spark, sf), "categorie")  # one row per category: bounded
    return ST.cumulative_sum(vc, F.struct(-F.col("n"), F.col("categorie")), "n", "cumsum")


@plan("dense_ids", with_contracts("""
SELECT acheteur_id, row_number() OVER (ORDER BY acheteur_id) - 1 AS id
FROM (SELECT DISTINCT acheteur_id FROM contracts WHERE acheteur_id IS NOT NULL) t"""), "2.5")
def dense_ids(spark, sf):
    return ST.dense_ids(contracts(spark, sf), "acheteur_id", "id")


@plan("sort_desc", with_contracts("SELECT uid, montant FROM contracts ORDER BY montant DESC NULLS LAST, uid"), "2.6")
def sort_desc(spark, sf):
    return contracts(spark, sf).select("uid", "montant").orderBy(F.desc_nulls_last("montant"), "uid")


@plan("topk_scores", with_contracts("""
SELECT uid, acheteur_id, titulaire_id, montant FROM contracts WHERE montant IS NOT NULL
ORDER BY montant DESC, uid LIMIT 5"""), "2.6")
def topk_scores(spark, sf):
    c = contracts(spark, sf).filter(F.col("montant").isNotNull())
    return c.select("uid", "acheteur_id", "titulaire_id", "montant").orderBy(F.desc("montant"), "uid").limit(5)


@plan("best_worst", """
SELECT * FROM (
  SELECT 'best' AS side, anomaly_type, percentage,
         CAST(row_number() OVER (ORDER BY percentage DESC, anomaly_type) AS INTEGER) AS rank FROM (""" +
      REPORT_SQL + """) r1
  UNION ALL
  SELECT 'worst', anomaly_type, percentage,
         CAST(row_number() OVER (ORDER BY percentage ASC, anomaly_type) AS INTEGER) FROM (""" + REPORT_SQL + """) r2
) t WHERE rank <= 3""", "2.6")
def best_worst(spark, sf):
    # ranks over the 10-row report: bounded
    from pyspark.sql import Window
    from bidscope.sources.tables import contracts_staged
    rep = FL.anomaly_report(contracts_staged(spark, sf), FL.params_for_tests()).select("anomaly_type", "percentage")
    best = rep.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("percentage"), "anomaly_type"))) \
              .withColumn("side", F.lit("best"))
    worst = rep.withColumn("rank", F.row_number().over(Window.orderBy(F.asc("percentage"), "anomaly_type"))) \
               .withColumn("side", F.lit("worst"))
    return best.unionByName(worst).filter(F.col("rank") <= 3).select("side", "anomaly_type", "percentage", "rank")


@plan("nlargest", with_contracts("""
SELECT acheteur_id, count(*) AS n FROM contracts WHERE acheteur_id IS NOT NULL GROUP BY 1
ORDER BY n DESC, acheteur_id LIMIT 10"""), "2.6")
def nlargest(spark, sf):
    from bidscope.operators.clean import top_keys
    return top_keys(contracts(spark, sf), "acheteur_id", 10)
