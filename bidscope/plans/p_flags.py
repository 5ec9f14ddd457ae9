"""§2.10 red-flag rules, report, removal; §2.5 burst windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.operators import flags as FL
from bidscope.plans.oracle import with_contracts
from bidscope.plans.registry import plan
from bidscope.sources.tables import contracts, contracts_staged

P = FL.params_for_tests()
COMP = "('Appel d''offres ouvert', 'Appel d''offres restreint')"
NONCOMP = "('Procédure adaptée', 'Marché négocié sans publicité')"

# --- SQL building blocks (DuckDB) -------------------------------------------
CAT_STATS = """cat_stats AS (
  SELECT categorie, avg(montant) AS m, stddev_samp(montant) AS s, count(*) AS n FROM contracts
  WHERE montant IS NOT NULL AND categorie IS NOT NULL GROUP BY categorie
  HAVING count(*) >= 200 AND stddev_samp(montant) > 0)"""
CONC_KEYS = """tot AS (SELECT acheteur_id, categorie, count(*) AS tot FROM contracts
                WHERE acheteur_id IS NOT NULL AND categorie IS NOT NULL GROUP BY 1, 2),
  tri AS (SELECT acheteur_id, categorie, titulaire_id, count(*) AS n FROM contracts
          WHERE acheteur_id IS NOT NULL AND categorie IS NOT NULL AND titulaire_id IS NOT NULL GROUP BY 1, 2, 3),
  conc AS (SELECT tri.* FROM tri JOIN tot USING (acheteur_id, categorie)
           WHERE CAST(n AS DOUBLE) / CAST(tot AS DOUBLE) > CAST(0.7 AS DOUBLE) AND tot > 2)"""


def pair_keys_sql(k: float) -> str:
    return f"""pt AS (SELECT acheteur_id, titulaire_id, coalesce(sum(montant), CAST(0 AS DOUBLE)) AS s,
                count(montant) AS cnt, count(*) AS n FROM contracts
                WHERE acheteur_id IS NOT NULL AND titulaire_id IS NOT NULL GROUP BY 1, 2),
  pst AS (SELECT avg(s) AS pm, stddev_samp(s) AS ps FROM pt),
  heavy AS (SELECT pt.* FROM pt, pst WHERE ps > 0 AND s > pm + CAST({k} AS DOUBLE) * ps AND cnt >= 2)"""


DAYS = """dd AS (SELECT uid, acheteur_region AS b, titulaire_id AS s, categorie AS c,
               CAST(TRY_CAST(dateNotification AS DATE) - DATE '1970-01-01' AS INTEGER) AS day FROM contracts
               WHERE acheteur_region IS NOT NULL AND titulaire_id IS NOT NULL AND categorie IS NOT NULL
                 AND TRY_CAST(dateNotification AS DATE) IS NOT NULL)"""


def members_sql(days: int, k: int) -> str:
    # brute force: start rows (k rows within [d, d+days]) joined to every row of the window
    return f"""{DAYS},
  starts AS (SELECT DISTINCT b, s, c, day FROM (
      SELECT b, s, c, day, count(*) OVER (PARTITION BY b, s, c ORDER BY day
             RANGE BETWEEN CURRENT ROW AND {days} FOLLOWING) AS fwd FROM dd) t WHERE fwd >= {k}),
  mem AS (SELECT DISTINCT dd.uid FROM dd JOIN starts st ON dd.b = st.b AND dd.s = st.s AND dd.c = st.c
          AND dd.day BETWEEN st.day AND st.day + {days})"""


REPORT_SQL = with_contracts("""
SELECT anomaly_type, CAST(n_flagged AS BIGINT) AS n_flagged,
       round(CAST(n_flagged AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total AS DOUBLE), 6) AS percentage,
       CASE WHEN CAST(n_flagged AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total AS DOUBLE) > 10 THEN 'Very High'
            WHEN CAST(n_flagged AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total AS DOUBLE) > 5 THEN 'High'
            WHEN CAST(n_flagged AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total AS DOUBLE) > 1 THEN 'Medium'
            WHEN CAST(n_flagged AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total AS DOUBLE) > CAST(0.1 AS DOUBLE) THEN 'Low'
            ELSE 'Very Low' END AS status,
       total AS total_contracts
FROM (
  SELECT 'single_bid_competitive' AS anomaly_type, (SELECT count(*) FROM contracts
     WHERE procedure IN """ + COMP + """ AND offresRecues = 1) AS n_flagged
  UNION ALL SELECT 'price_inflation', (SELECT count(*) FROM contracts c JOIN cat_stats USING (categorie)
     WHERE c.montant > m + CAST(3 AS DOUBLE) * s)
  UNION ALL SELECT 'price_deflation', (SELECT count(*) FROM contracts c JOIN cat_stats USING (categorie)
     WHERE c.montant > 0 AND c.montant < greatest(m - CAST(1 AS DOUBLE) * s, CAST(0 AS DOUBLE)))
  UNION ALL SELECT 'procedure_manipulation', (SELECT count(*) FROM contracts
     WHERE procedure IN """ + NONCOMP + """ AND montant > (SELECT quantile_cont(montant, 0.75) FROM contracts))
  UNION ALL SELECT 'suspicious_modifications', (SELECT count(*) FROM contracts
     WHERE dureeMois > (SELECT quantile_cont(dureeMois, 0.95) FROM contracts))
  UNION ALL SELECT 'high_market_concentration', (SELECT coalesce(sum(n), 0) FROM conc)
  UNION ALL SELECT 'temporal_clustering', (SELECT 4 * count(*) FROM (SELECT DISTINCT b, s, c FROM (
     SELECT b, s, c, lead(day, 3) OVER (PARTITION BY b, s, c ORDER BY day) - day AS span FROM dd) t
     WHERE span <= 30) g)
  UNION ALL SELECT 'excessive_subcontracting', (SELECT count(*) FROM contracts WHERE sousTraitanceDeclaree = 1)
  UNION ALL SELECT 'short_contract_duration', (SELECT count(*) FROM contracts WHERE dureeMois > 0 AND dureeMois < 1)
  UNION ALL SELECT 'suspicious_buyer_supplier_pairs', (SELECT coalesce(sum(n), 0) FROM heavy)
) x, (SELECT count(*) AS total FROM contracts) t""", ",\n".join([CAT_STATS, CONC_KEYS, pair_keys_sql(2.0), DAYS]))


# of a contract: what the removable rules, and what bursts read
BURST_COLUMNS = tuple(dict.fromkeys(("uid", P.date, *FL.temporal_keys(P))))
RULE_COLUMNS = tuple(dict.fromkeys((*BURST_COLUMNS, P.buyer, P.supplier, P.category, P.amount, "procedure", "offresRecues")))


def _c(spark, sf, columns=None):
    # ten rules read the contract view: stage it once
    return contracts_staged(spark, sf, columns)


@plan("anomaly_report", REPORT_SQL, "2.10")
def anomaly_report(spark, sf):
    return FL.anomaly_report(_c(spark, sf), P)


@plan("flag_single_bid", with_contracts(
    f"SELECT uid, procedure, offresRecues FROM contracts WHERE procedure IN {COMP} AND offresRecues = 1"), "2.10")
def flag_single_bid(spark, sf):
    # a single read of the view: staging would only add a write
    return contracts(spark, sf).filter(FL.single_bid(P)).select("uid", "procedure", "offresRecues")


@plan("flag_price_inflation", with_contracts(
    "SELECT c.uid, c.categorie, c.montant FROM contracts c JOIN cat_stats USING (categorie) "
    "WHERE c.montant > m + CAST(3 AS DOUBLE) * s", CAT_STATS), "2.10")
def flag_price_inflation(spark, sf):
    return FL.with_price_flags(_c(spark, sf), P).filter("price_inflation").select("uid", "categorie", "montant")


@plan("flag_price_deflation", with_contracts(
    "SELECT c.uid, c.categorie, c.montant FROM contracts c JOIN cat_stats USING (categorie) "
    "WHERE c.montant > 0 AND c.montant < greatest(m - CAST(1 AS DOUBLE) * s, CAST(0 AS DOUBLE))", CAT_STATS), "2.10")
def flag_price_deflation(spark, sf):
    return FL.with_price_flags(_c(spark, sf), P).filter("price_deflation").select("uid", "categorie", "montant")


@plan("flag_procedure_manipulation", with_contracts(
    f"SELECT uid, procedure, montant FROM contracts WHERE procedure IN {NONCOMP} "
    "AND montant > (SELECT quantile_cont(montant, 0.75) FROM contracts)"), "2.10")
def flag_procedure_manipulation(spark, sf):
    return FL.with_percentile_flags(_c(spark, sf), P).filter("procedure_manipulation") \
        .select("uid", "procedure", "montant")


@plan("flag_long_duration", with_contracts(
    "SELECT uid, dureeMois FROM contracts WHERE dureeMois > (SELECT quantile_cont(dureeMois, 0.95) FROM contracts)"),
    "2.10")
def flag_long_duration(spark, sf):
    return FL.with_percentile_flags(_c(spark, sf), P).filter("suspicious_modifications").select("uid", "dureeMois")


@plan("flag_concentration", with_contracts(
    "SELECT c.uid, c.acheteur_id, c.categorie, c.titulaire_id FROM contracts c "
    "JOIN conc USING (acheteur_id, categorie, titulaire_id)", CONC_KEYS), "2.10")
def flag_concentration(spark, sf):
    df = _c(spark, sf)
    keys = FL.concentration_keys(df, P).drop("_n")
    return df.join(keys, [P.buyer, P.category, P.supplier], "left_semi") \
             .select("uid", "acheteur_id", "categorie", "titulaire_id")


@plan("flag_temporal_cluster", with_contracts("""
SELECT DISTINCT b AS acheteur_region, s AS titulaire_id, c AS categorie FROM (
  SELECT b, s, c, lead(day, 3) OVER (PARTITION BY b, s, c ORDER BY day) - day AS span FROM dd) t
WHERE span <= 30""", DAYS), "2.10")
def flag_temporal_cluster(spark, sf):
    return FL.burst_groups(_c(spark, sf), FL.temporal_keys(P), P.date, 30, 4)


@plan("flag_subcontracting", with_contracts(
    "SELECT uid, sousTraitanceDeclaree FROM contracts WHERE sousTraitanceDeclaree = 1"), "2.10")
def flag_subcontracting(spark, sf):
    # a single read of the view: staging would only add a write
    return contracts(spark, sf).filter(FL.subcontracting()).select("uid", "sousTraitanceDeclaree")


@plan("flag_short_duration", with_contracts(
    "SELECT uid, dureeMois FROM contracts WHERE dureeMois > 0 AND dureeMois < 1"), "2.10")
def flag_short_duration(spark, sf):
    # a single read of the view: staging would only add a write
    return contracts(spark, sf).filter(FL.short_duration(P)).select("uid", "dureeMois")


@plan("flag_heavy_pairs", with_contracts(
    "SELECT c.uid, c.acheteur_id, c.titulaire_id FROM contracts c JOIN heavy USING (acheteur_id, titulaire_id)",
    pair_keys_sql(2.0)), "2.10")
def flag_heavy_pairs(spark, sf):
    df = _c(spark, sf)
    keys = FL.heavy_pair_keys(df, P).select(P.buyer, P.supplier)
    return df.join(keys, [P.buyer, P.supplier], "left_semi").select("uid", "acheteur_id", "titulaire_id")


IDENTIFY_SQL = with_contracts(f"""
SELECT uid, single_bid_competitive, price_inflation, price_deflation, high_market_concentration,
       temporal_clustering, suspicious_buyer_supplier_pairs FROM (
  SELECT c.uid,
    coalesce(c.procedure IN {COMP} AND c.offresRecues = 1, false) AS single_bid_competitive,
    coalesce(c.montant > st.m + CAST(3 AS DOUBLE) * st.s, false) AS price_inflation,
    coalesce(c.montant > 0 AND c.montant < greatest(st.m - CAST(1 AS DOUBLE) * st.s, CAST(0 AS DOUBLE)), false)
      AS price_deflation,
    conc.n IS NOT NULL AS high_market_concentration,
    mem.uid IS NOT NULL AS temporal_clustering,
    heavy.n IS NOT NULL AS suspicious_buyer_supplier_pairs
  FROM contracts c LEFT JOIN cat_stats st USING (categorie)
  LEFT JOIN conc USING (acheteur_id, categorie, titulaire_id)
  LEFT JOIN heavy USING (acheteur_id, titulaire_id)
  LEFT JOIN mem ON mem.uid = c.uid) t
WHERE single_bid_competitive OR price_inflation OR price_deflation OR high_market_concentration
   OR temporal_clustering OR suspicious_buyer_supplier_pairs""",
    ",\n".join([CAT_STATS, CONC_KEYS, pair_keys_sql(2.0), members_sql(15, 5)]))


@plan("identify_anomalies", IDENTIFY_SQL, "2.10")
def identify_anomalies(spark, sf):
    return FL.identify_anomalies(_c(spark, sf, RULE_COLUMNS), P, FL.REMOVABLE, strict=True)


@plan("clean_dataset", with_contracts(f"""
SELECT c.uid, c.acheteur_id, c.titulaire_id, c.montant FROM contracts c
LEFT JOIN cat_stats st USING (categorie)
LEFT JOIN conc USING (acheteur_id, categorie, titulaire_id)
LEFT JOIN heavy USING (acheteur_id, titulaire_id)
LEFT JOIN mem ON mem.uid = c.uid
WHERE NOT (coalesce(c.procedure IN {COMP} AND c.offresRecues = 1, false)
        OR coalesce(c.montant > st.m + CAST(3 AS DOUBLE) * st.s, false)
        OR coalesce(c.montant > 0 AND c.montant < greatest(st.m - CAST(1 AS DOUBLE) * st.s, CAST(0 AS DOUBLE)), false)
        OR conc.n IS NOT NULL OR mem.uid IS NOT NULL OR heavy.n IS NOT NULL)""",
    ",\n".join([CAT_STATS, CONC_KEYS, pair_keys_sql(1.5), members_sql(30, 3)])), "2.10")
def clean_dataset(spark, sf):
    df = _c(spark, sf, RULE_COLUMNS)
    return FL.clean_dataset(df, P, FL.REMOVABLE, strict=False).select("uid", "acheteur_id", "titulaire_id", "montant")


@plan("rule_same_pair_limit", with_contracts("""
SELECT c.uid, c.acheteur_id, c.titulaire_id, p.n_contracts FROM contracts c JOIN (
  SELECT acheteur_id, titulaire_id, count(*) AS n_contracts FROM contracts GROUP BY 1, 2 HAVING count(*) > 10) p
USING (acheteur_id, titulaire_id)"""), "2.10")
def rule_same_pair_limit(spark, sf):
    return FL.same_pair_limit(_c(spark, sf), P, 10).select("uid", "acheteur_id", "titulaire_id", "n_contracts")


@plan("rule_amount_variation", with_contracts("""
SELECT c.uid, c.categorie, m.category_median,
       round(abs(c.montant - m.category_median) / m.category_median, 9) AS variation
FROM contracts c JOIN (SELECT categorie, quantile_cont(montant, 0.5) AS category_median FROM contracts
                       GROUP BY 1) m USING (categorie)
WHERE m.category_median <> 0 AND abs(c.montant - m.category_median) / m.category_median > CAST(0.5 AS DOUBLE)"""),
    "2.10")
def rule_amount_variation(spark, sf):
    out = FL.amount_variation(_c(spark, sf), P, 0.5)
    return out.select("uid", "categorie", "category_median", F.round("variation", 9).alias("variation"))


# --- §2.5 burst windows -----------------------------------------------------
@plan("burst_lead", with_contracts("""
SELECT DISTINCT b AS acheteur_region, s AS titulaire_id, c AS categorie FROM (
  SELECT b, s, c, lead(day, 3) OVER (PARTITION BY b, s, c ORDER BY day) - day AS span FROM dd) t
WHERE span <= 30""", DAYS), "2.5")
def burst_lead(spark, sf):
    return FL.burst_groups(_c(spark, sf), FL.temporal_keys(P), P.date, 30, 4)


@plan("burst_members", with_contracts("SELECT c.uid, c.dateNotification FROM contracts c JOIN mem USING (uid)",
                                      members_sql(15, 5)), "2.5")
def burst_members(spark, sf):
    return FL.burst_members(_c(spark, sf, BURST_COLUMNS), FL.temporal_keys(P), P.date, 15, 5).select("uid", "dateNotification")


@plan("burst_members_loose", with_contracts("SELECT c.uid, c.dateNotification FROM contracts c JOIN mem USING (uid)",
                                            members_sql(30, 3)), "2.5")
def burst_members_loose(spark, sf):
    return FL.burst_members(_c(spark, sf, BURST_COLUMNS), FL.temporal_keys(P), P.date, 30, 3).select("uid", "dateNotification")
