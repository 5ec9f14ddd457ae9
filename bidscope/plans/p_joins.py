"""§2.3 joins and §2.7 set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.operators import enrich as E
from bidscope.operators import flags as FL
from bidscope.operators import stats as ST
from bidscope.plans.oracle import CPV_CODES_SELECT, REGISTRY_SELECT, with_contracts
from bidscope.plans.registry import plan
from bidscope.session import stage_small as stage
from bidscope.sources.tables import contracts, cpv_codes, registry

# Contract codes as they arrive in the raw table: codes with check digit 3 are
# absent from the list; half of those come cut to four characters, so both
# the "no match" and the "prefix match" paths are exercised.
DIRTY_SQL = ("CASE WHEN codeCPV LIKE '%-3' AND substr(codeCPV, 3, 2) < '25' "
             "THEN substr(codeCPV, 1, 4) ELSE codeCPV END")
CPV_CTES = f"cpv AS ({CPV_CODES_SELECT}),\n  dirty AS (SELECT uid, {DIRTY_SQL} AS codeCPV FROM contracts)"


def dirty_codes(spark, sf):
    c = contracts(spark, sf)
    code = F.col("codeCPV")
    dirty = F.when(code.endswith("-3") & (F.substring(code, 3, 2) < F.lit("25")), F.substring(code, 1, 4)) \
             .otherwise(code)
    return c.select("uid", dirty.alias("codeCPV"))


@plan("cpv_anti", with_contracts(
    "SELECT DISTINCT codeCPV FROM dirty WHERE codeCPV NOT IN (SELECT CODE FROM cpv)", CPV_CTES), "2.3")
def cpv_anti(spark, sf):
    return E.cpv_anti(dirty_codes(spark, sf), cpv_codes(spark, sf))


@plan("cpv_semi", with_contracts(
    "SELECT DISTINCT codeCPV FROM dirty WHERE codeCPV IN (SELECT CODE FROM cpv)", CPV_CTES), "2.3")
def cpv_semi(spark, sf):
    return E.cpv_semi(dirty_codes(spark, sf), cpv_codes(spark, sf))


PREFIX_SQL = """pm AS (SELECT m.codeCPV, count(cpv.CODE) AS count_similar, min(cpv.CODE) AS new_CPV
  FROM (SELECT DISTINCT codeCPV FROM dirty WHERE codeCPV NOT IN (SELECT CODE FROM cpv)) m
  LEFT JOIN cpv ON starts_with(cpv.CODE, m.codeCPV) GROUP BY m.codeCPV)"""
MAPPING_SQL = """mapping AS (
  SELECT DISTINCT d.codeCPV, cpv.FR AS codeCPV_FR FROM dirty d JOIN cpv ON d.codeCPV = cpv.CODE
  UNION ALL
  SELECT pm.codeCPV, cpv.FR AS codeCPV_FR FROM pm LEFT JOIN cpv ON pm.new_CPV = cpv.CODE)"""


@plan("cpv_prefix_match", with_contracts("SELECT * FROM pm", CPV_CTES + ",\n" + PREFIX_SQL), "2.3")
def cpv_prefix_match(spark, sf):
    cpv = cpv_codes(spark, sf)
    return E.cpv_prefix_match(E.cpv_anti(dirty_codes(spark, sf), cpv), cpv)


@plan("union_mappings", with_contracts("SELECT * FROM mapping",
                                       CPV_CTES + ",\n" + PREFIX_SQL + ",\n" + MAPPING_SQL), "2.7")
def union_mappings(spark, sf):
    return E.cpv_mapping(dirty_codes(spark, sf), cpv_codes(spark, sf))


@plan("cpv_description", with_contracts(
    "SELECT d.uid, d.codeCPV, mapping.codeCPV_FR FROM dirty d LEFT JOIN mapping USING (codeCPV)",
    CPV_CTES + ",\n" + PREFIX_SQL + ",\n" + MAPPING_SQL), "2.3")
def cpv_description(spark, sf):
    # read for its codes and for its rows: written once
    return E.cpv_description(stage(dirty_codes(spark, sf), "codes"), cpv_codes(spark, sf))


@plan("enrich_registry", with_contracts("""
SELECT c.uid, b.trancheEffectifsUniteLegale AS acheteur_tranche_effectif, b.categorieEntreprise AS acheteur_categorie,
       s.trancheEffectifsUniteLegale AS titulaire_tranche_effectif, s.categorieEntreprise AS titulaire_categorie
FROM contracts c LEFT JOIN reg b ON 'B' || c.acheteur_siren = b.siren
LEFT JOIN reg s ON 'S' || c.titulaire_siren = s.siren""", f"reg AS ({REGISTRY_SELECT})"), "2.3")
def enrich_registry(spark, sf):
    df = contracts(spark, sf).select("uid", "acheteur_siren", "titulaire_siren")
    out = E.enrich_registry(df, registry(spark, sf), buyer_prefix="B", supplier_prefix="S")
    return out.drop("acheteur_siren", "titulaire_siren")


@plan("membership_join", with_contracts("""
SELECT uid, titulaire_id FROM contracts WHERE titulaire_id IN (
  SELECT titulaire_id FROM contracts GROUP BY 1 ORDER BY count(*) DESC, titulaire_id LIMIT 5)"""), "2.3")
def membership_join(spark, sf):
    from bidscope.operators.clean import top_keys
    c = contracts(spark, sf).select("uid", "titulaire_id")
    keys = F.broadcast(top_keys(c, "titulaire_id", 5).select("titulaire_id"))  # ≤ 5 rows
    return E.membership_join(c, keys, "titulaire_id")


@plan("group_stats_join", with_contracts("""
SELECT c.uid, c.categorie, round(s.group_mean, 4) AS group_mean, round(s.group_std, 4) AS group_std
FROM contracts c LEFT JOIN (SELECT categorie, avg(montant) AS group_mean, stddev_samp(montant) AS group_std
                            FROM contracts GROUP BY 1) s USING (categorie)"""), "2.3")
def group_stats_join(spark, sf):
    out = E.group_stats_join(contracts(spark, sf).select("uid", "categorie", "montant"), "categorie", "montant")
    return out.select("uid", "categorie", F.round("group_mean", 4).alias("group_mean"),
                      F.round("group_std", 4).alias("group_std"))


@plan("pair_join_back", with_contracts("""
SELECT c.uid, c.acheteur_id, c.titulaire_id FROM contracts c JOIN (
  SELECT acheteur_id, titulaire_id FROM contracts GROUP BY 1, 2 HAVING count(*) >= 5) k
USING (acheteur_id, titulaire_id)"""), "2.3")
def pair_join_back(spark, sf):
    c = contracts(spark, sf).select("uid", "acheteur_id", "titulaire_id")
    keys = ST.group_size(c, ["acheteur_id", "titulaire_id"]).filter(F.col("n") >= 5)
    return E.pair_join_back(c, keys, ["acheteur_id", "titulaire_id"])


# --- §2.7 set operations --------------------------------------------------
@plan("append_rows", with_contracts("""
SELECT uid, montant, categorie FROM contracts
UNION ALL
SELECT uid || '-syn', montant * CAST(2 AS DOUBLE), NULL FROM contracts
WHERE procedure IN ('Appel d''offres ouvert', 'Appel d''offres restreint') AND offresRecues = 1"""), "2.7")
def append_rows(spark, sf):
    c = contracts(spark, sf)
    base = c.select("uid", "montant", "categorie")
    extra = c.filter(FL.single_bid()).select(F.concat("uid", F.lit("-syn")).alias("uid"),
                                              (F.col("montant") * F.lit(2.0)).alias("montant"))
    return ST.append_rows(base, extra)


UNION_SQL = """fl AS (SELECT uid FROM contracts WHERE procedure IN ('Appel d''offres ouvert', 'Appel d''offres restreint')
                AND offresRecues = 1
             UNION SELECT uid FROM contracts WHERE sousTraitanceDeclaree = 1
             UNION SELECT uid FROM contracts WHERE dureeMois > 0 AND dureeMois < 1)"""


def _flag_union(c):
    a = c.filter(FL.single_bid()).select("uid")
    b = c.filter(FL.subcontracting()).select("uid")
    d = c.filter(FL.short_duration()).select("uid")
    return a.union(b).union(d).distinct()


@plan("flag_union", with_contracts("SELECT uid FROM fl", UNION_SQL), "2.7")
def flag_union(spark, sf):
    return _flag_union(contracts(spark, sf))


@plan("rows_except", with_contracts("SELECT uid, montant FROM contracts WHERE uid NOT IN (SELECT uid FROM fl)",
                                    UNION_SQL), "2.7")
def rows_except(spark, sf):
    c = contracts(spark, sf)
    return ST.rows_except(c.select("uid", "montant"), _flag_union(c))


@plan("replace_rows", with_contracts("""
SELECT uid, CASE WHEN sousTraitanceDeclaree = 1 THEN montant * CAST(3 AS DOUBLE) ELSE montant END AS montant,
       procedure FROM contracts"""), "2.7")
def replace_rows(spark, sf):
    c = contracts(spark, sf).select("uid", "montant", "procedure", "sousTraitanceDeclaree")
    new = c.filter(FL.subcontracting()).select("uid", (F.col("montant") * F.lit(3.0)).alias("montant"), "procedure")
    return ST.replace_rows(c.select("uid", "montant", "procedure"), new)
