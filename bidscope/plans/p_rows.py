"""§2.2 projections, filters, row selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.operators import clean as C
from bidscope.plans.oracle import cpv_level_sql, md5_sql, with_contracts
from bidscope.plans.registry import plan
from bidscope.functions.columns import cpv_level
from bidscope.sources.tables import contracts

NUM = ["montant", "dureeMois", "offresRecues", "tauxAvance"]
BIN = ["sousTraitanceDeclaree", "origineFrance", "marcheInnovant"]
CAT = ["procedure", "nature", "formePrix", "ccag", "typeGroupementOperateurs"]


@plan("select_columns", with_contracts(f"SELECT uid, {', '.join(NUM + BIN + CAT)} FROM contracts"), "2.2")
def select_columns(spark, sf):
    return C.select_columns(contracts(spark, sf), NUM, BIN, CAT)


@plan("drop_columns", with_contracts(
    "SELECT * EXCLUDE (acheteur_siren, titulaire_siren, idAccordCadre) FROM contracts"), "2.2")
def drop_columns(spark, sf):
    return C.drop_columns(contracts(spark, sf), ["acheteur_siren", "titulaire_siren", "idAccordCadre"])


@plan("rename_columns", with_contracts(
    "SELECT uid, acheteur_id AS buyer, titulaire_id AS supplier, montant AS amount FROM contracts"), "2.2")
def rename_columns(spark, sf):
    df = contracts(spark, sf).select("uid", "acheteur_id", "titulaire_id", "montant")
    return C.rename_columns(df, {"acheteur_id": "buyer", "titulaire_id": "supplier", "montant": "amount"})


@plan("filter_amount", with_contracts("""
SELECT uid, montant FROM contracts
WHERE montant IS NULL OR montant BETWEEN CAST(20000 AS DOUBLE) AND CAST(50000000 AS DOUBLE)"""), "2.2")
def filter_amount(spark, sf):
    return C.filter_amount(contracts(spark, sf).select("uid", "montant"), 20000.0, 5e7)


@plan("filter_duration", with_contracts(
    "SELECT uid, dureeMois FROM contracts WHERE dureeMois <= CAST(40 AS DOUBLE)"), "2.2")
def filter_duration(spark, sf):
    # test data durations are 0.25..50 months; 40 exercises the cut
    return C.filter_duration(contracts(spark, sf).select("uid", "dureeMois"), 40.0)


@plan("filter_year", with_contracts("""
SELECT uid, dateNotification, TRY_CAST(substr(dateNotification, 1, 4) AS INTEGER) AS annee FROM contracts
WHERE TRY_CAST(substr(dateNotification, 1, 4) AS INTEGER) > 1996
  AND TRY_CAST(substr(dateNotification, 1, 4) AS INTEGER) <= 2000"""), "2.2")
def filter_year(spark, sf):
    return C.filter_year(contracts(spark, sf).select("uid", "dateNotification"), 1996, 2000)


@plan("filter_not_equal", with_contracts(
    "SELECT uid, dateNotification FROM contracts WHERE dateNotification IS NULL OR dateNotification <> '1998-08-02'"),
    "2.2")
def filter_not_equal(spark, sf):
    return C.filter_not_equal(contracts(spark, sf).select("uid", "dateNotification"), "dateNotification", "1998-08-02")


@plan("filter_valid_parties", with_contracts("""
SELECT uid, acheteur_id, titulaire_id FROM contracts WHERE acheteur_id IS NOT NULL AND titulaire_id IS NOT NULL"""),
    "2.2")
def filter_valid_parties(spark, sf):
    df = contracts(spark, sf).select("uid", "acheteur_id", "titulaire_id")
    return C.filter_valid_parties(df, "acheteur_id", "titulaire_id")


@plan("filter_min_group", with_contracts(f"""
SELECT uid, cpv3, dureeMois FROM (
  SELECT uid, {cpv_level_sql('codeCPV', 3)} AS cpv3, dureeMois,
         count(*) OVER (PARTITION BY {cpv_level_sql('codeCPV', 3)}) AS n FROM contracts) t
WHERE n > 200 AND dureeMois IS NOT NULL"""), "2.2")
def filter_min_group(spark, sf):
    df = contracts(spark, sf).select("uid", cpv_level("codeCPV", 3).alias("cpv3"), "dureeMois")
    return C.filter_min_group(df, "cpv3", 200, ["dureeMois"])


@plan("filter_top_categories", with_contracts(f"""
SELECT uid, cpv3 FROM (SELECT uid, {cpv_level_sql('codeCPV', 3)} AS cpv3 FROM contracts) t
WHERE cpv3 IN (SELECT cpv3 FROM (SELECT {cpv_level_sql('codeCPV', 3)} AS cpv3, count(*) AS n FROM contracts
               GROUP BY 1 ORDER BY n DESC, cpv3 LIMIT 40) k)"""), "2.2")
def filter_top_categories(spark, sf):
    df = contracts(spark, sf).select("uid", cpv_level("codeCPV", 3).alias("cpv3"))
    return C.filter_top_categories(df, "cpv3", 40)


@plan("drop_largest", with_contracts("""
SELECT uid, dureeMois FROM contracts WHERE uid NOT IN (
  SELECT uid FROM contracts WHERE dureeMois IS NOT NULL ORDER BY dureeMois DESC, uid LIMIT 2)"""), "2.2")
def drop_largest(spark, sf):
    return C.drop_largest(contracts(spark, sf).select("uid", "dureeMois"), "dureeMois", 2)


@plan("filter_isin", with_contracts("""
SELECT uid, procedure FROM contracts WHERE procedure IN ('Appel d''offres ouvert', 'Appel d''offres restreint')"""),
    "2.2")
def filter_isin(spark, sf):
    from bidscope.sources.tables import COMPETITIVE_PROCEDURES
    return C.filter_isin(contracts(spark, sf).select("uid", "procedure"), "procedure", COMPETITIVE_PROCEDURES)


@plan("sample_rows", with_contracts(f"""
SELECT uid, montant FROM contracts ORDER BY {md5_sql('uid', seed=42)}, uid LIMIT 500"""), "2.2")
def sample_rows(spark, sf):
    return C.sample_rows(contracts(spark, sf).select("uid", "montant"), 500, 42)


@plan("split_random", with_contracts("""
SELECT uid, CASE WHEN (CAST(('0x' || substr(md5(uid || ':' || '7'), 1, 7)) AS BIGINT) / CAST(268435456 AS DOUBLE))
                      < CAST(0.2 AS DOUBLE) THEN 'test' ELSE 'train' END AS split FROM contracts"""), "2.2")
def split_random(spark, sf):
    return C.split_random(contracts(spark, sf).select("uid"), 0.2, 7)


@plan("split_stratified", with_contracts(f"""
SELECT uid, cpv2, CASE WHEN rk < ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test'
                       WHEN rk < ceil(n * CAST(0.36 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM (
  SELECT uid, cpv2, row_number() OVER (PARTITION BY cpv2 ORDER BY substr(md5(uid || ':' || '42'), 1, 13)) - 1 AS rk,
         count(*) OVER (PARTITION BY cpv2) AS n
  FROM (SELECT uid, {cpv_level_sql('codeCPV', 2)} AS cpv2 FROM contracts) a) t"""), "2.2")
def split_stratified(spark, sf):
    df = contracts(spark, sf).select("uid", cpv_level("codeCPV", 2).alias("cpv2"))
    return C.split_stratified(df, "cpv2", 42)


@plan("row_limit", with_contracts("SELECT uid, montant FROM contracts ORDER BY montant DESC, uid LIMIT 100"), "2.2")
def row_limit(spark, sf):
    return C.row_limit(contracts(spark, sf).select("uid", "montant"), 100, [F.desc("montant"), F.asc("uid")])
