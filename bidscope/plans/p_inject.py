"""§2.11 synthetic anomaly injection plans."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from bidscope.operators import inject as IJ
from bidscope.plans.oracle import with_contracts
from bidscope.plans.registry import plan
from bidscope.session import scratch_path
from bidscope.sources.tables import contracts

P = IJ.InjectParams(category="categorie")
SEED = P.seed
COMP = "('Appel d''offres ouvert', 'Appel d''offres restreint')"


def h13(*parts: str, salt: str) -> str:
    inner = " || ':' || ".join([f"CAST({x} AS VARCHAR)" for x in parts] + [f"'{salt}'", f"'{SEED}'"])
    return f"substr(md5({inner}), 1, 13)"


def u7(*parts: str, salt: str) -> str:
    inner = " || ':' || ".join([f"CAST({x} AS VARCHAR)" for x in parts] + [f"'{salt}'", f"'{SEED}'"])
    return f"(CAST(('0x' || substr(md5({inner}), 1, 7)) AS BIGINT) / CAST(268435456 AS DOUBLE))"


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


NEW = ["montant", "offresRecues", "procedure", "dureeMois", "sousTraitanceDeclaree", "titulaire_id",
       "dateNotification"]
NEW_T = {"montant": "DOUBLE", "offresRecues": "DOUBLE", "procedure": "VARCHAR", "dureeMois": "DOUBLE",
         "sousTraitanceDeclaree": "DOUBLE", "titulaire_id": "VARCHAR", "dateNotification": "VARCHAR"}


def shape(t: str, src: str, slot: str = "0", **new: str) -> str:
    cols = [f"uid", f"'{t}' AS anomaly_type", f"{IJ.TYPE_CODE[t]} AS type_code", f"CAST({slot} AS INTEGER) AS slot"]
    cols += [f"CAST({new.get(c, 'NULL')} AS {NEW_T[c]}) AS new_{c}" for c in NEW]
    return f"SELECT {', '.join(cols)} FROM {src}"


def take_rows(t: str, where: str, extra_cols: str = "") -> str:
    return (f"(SELECT * FROM (SELECT *{extra_cols}, row_number() OVER (ORDER BY {h13('uid', salt=t)}) AS _rn "
            f"FROM {where}) a, nn WHERE _rn <= nn.n)")


BASE = f"""nn AS (SELECT greatest(1, CAST(floor({D('count(*)')} * {D(0.05)}) AS BIGINT) // 10) AS n FROM contracts),
  cst AS (SELECT categorie, avg(montant) AS cm, stddev_samp(montant) AS cs FROM contracts
          WHERE montant IS NOT NULL AND categorie IS NOT NULL AND montant > 0 GROUP BY 1
          HAVING count(*) >= 200 AND stddev_samp(montant) > 0)"""

T_SQL = {}
t = "single_bid_competitive"
T_SQL[t] = shape(t, take_rows(t, f"contracts WHERE procedure IN {COMP} AND offresRecues > 1"), offresRecues=D(1))
t = "price_inflation"
T_SQL[t] = shape(t, take_rows(t, "(SELECT c.*, cm + 3 * cs AS thr FROM contracts c JOIN cst USING (categorie) "
                                 "WHERE c.montant IS NOT NULL AND c.montant > 0 AND c.montant < cm + 3 * cs)"),
                 montant=f"thr * ({D(1.1)} + {u7('uid', salt=t + ':m')} * {D(0.4)})")
t = "price_deflation"
T_SQL[t] = shape(t, take_rows(t, "(SELECT c.*, cm, greatest(cm - 3 * cs, 0) AS thr FROM contracts c "
                                 "JOIN cst USING (categorie) WHERE c.montant IS NOT NULL AND c.montant > 0 "
                                 "AND c.montant > greatest(cm - 3 * cs, 0))"),
                 montant=f"CASE WHEN thr > 0 THEN thr * ({D(0.5)} + {u7('uid', salt=t + ':m')} * {D(0.4)}) "
                         f"ELSE cm * ({D(0.01)} + {u7('uid', salt=t + ':m')} * {D(0.04)}) END")
t = "procedure_manipulation"
T_SQL[t] = shape(t, take_rows(t, f"contracts WHERE procedure IN {COMP}"),
                 procedure=f"CASE WHEN {u7('uid', salt=t + ':p')} < {D(0.5)} THEN 'Procédure adaptée' "
                           f"ELSE 'Marché négocié sans publicité' END")
t = "suspicious_modifications"
T_SQL[t] = shape(t, take_rows(t, "contracts WHERE dureeMois > 0 AND dureeMois < 36"),
                 dureeMois=f"dureeMois * ({D(2.5)} + {u7('uid', salt=t + ':d')} * {D(2.5)})")
t = "excessive_subcontracting"
T_SQL[t] = shape(t, take_rows(t, "contracts WHERE sousTraitanceDeclaree = 0"), sousTraitanceDeclaree=D(1))
t = "short_contract_duration"
T_SQL[t] = shape(t, take_rows(t, "contracts WHERE dureeMois > 1"),
                 dureeMois=f"{D(0.1)} + {u7('uid', salt=t + ':d')} * {D(0.8)}")

t = "high_market_concentration"
T_SQL[t] = shape(t, f"""(
  WITH grp AS (SELECT acheteur_id, categorie FROM contracts WHERE acheteur_id IS NOT NULL AND categorie IS NOT NULL
               GROUP BY 1, 2 HAVING count(*) >= 3 AND count(DISTINCT titulaire_id) > 1),
  gsel AS (SELECT acheteur_id, categorie FROM (SELECT *, row_number() OVER (ORDER BY
             {h13('acheteur_id', 'categorie', salt=t + ':g')}) AS rn FROM grp) a, nn WHERE rn <= nn.n // 3),
  dom AS (SELECT acheteur_id, categorie,
                 arg_min(titulaire_id, {h13('acheteur_id', 'categorie', 'titulaire_id', salt=t + ':s')}) AS dom
          FROM (SELECT DISTINCT acheteur_id, categorie, titulaire_id FROM contracts WHERE titulaire_id IS NOT NULL) d
          JOIN gsel USING (acheteur_id, categorie) GROUP BY 1, 2),
  r AS (SELECT c.uid, c.acheteur_id, c.categorie, row_number() OVER (PARTITION BY c.acheteur_id, c.categorie
          ORDER BY {h13('c.uid', salt=t + ':r')}) AS rk FROM contracts c JOIN gsel USING (acheteur_id, categorie))
  SELECT r.uid, dom.dom FROM r JOIN dom USING (acheteur_id, categorie) WHERE rk <= 3) x""", titulaire_id="dom")

t = "temporal_clustering"
T_SQL[t] = shape(t, f"""(
  WITH tg AS (SELECT acheteur_id, titulaire_id, categorie, count(*) AS gsize FROM contracts
              WHERE acheteur_id IS NOT NULL AND titulaire_id IS NOT NULL AND categorie IS NOT NULL
                AND TRY_CAST(dateNotification AS DATE) IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2),
  ts AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY
           {h13('acheteur_id', 'titulaire_id', 'categorie', salt=t + ':g')}) AS rn FROM tg) a, nn
         WHERE rn <= greatest(1, nn.n // 4)),
  tr AS (SELECT c.uid, s.acheteur_id, s.titulaire_id, s.categorie, s.gsize,
                row_number() OVER (PARTITION BY c.acheteur_id, c.titulaire_id, c.categorie
                                   ORDER BY {h13('c.uid', salt=t + ':r')}) - 1 AS rk
         FROM contracts c JOIN ts s USING (acheteur_id, titulaire_id, categorie)
         WHERE TRY_CAST(c.dateNotification AS DATE) IS NOT NULL),
  sl AS (SELECT tr.*, CAST(s.range AS INTEGER) AS slot FROM tr, range(0, 4) s
         WHERE rk < 4 AND s.range % least(gsize, 4) = rk)
  SELECT uid, slot, strftime(make_date(2023,
            CAST(floor({u7('acheteur_id', 'titulaire_id', 'categorie', salt=t + ':month')} * 12) AS INTEGER) + 1,
            CAST(floor({u7('acheteur_id', 'titulaire_id', 'categorie', salt=t + ':day')} * 28) AS INTEGER) + 1)
          + CAST(floor({u7('uid', 'slot', salt=t + ':off')} * 30) AS INTEGER), '%Y-%m-%d') AS nd FROM sl) x""",
                 slot="slot", dateNotification="nd")

t = "suspicious_buyer_supplier_pairs"
T_SQL[t] = shape(t, f"""(
  WITH pt AS (SELECT acheteur_id, titulaire_id, coalesce(sum(montant), {D(0)}) AS psum, count(montant) AS pcnt
              FROM contracts WHERE acheteur_id IS NOT NULL AND titulaire_id IS NOT NULL GROUP BY 1, 2),
  pst AS (SELECT avg(psum) AS pm, stddev_samp(psum) AS ps FROM pt),
  pe AS (SELECT pt.*, pm + 2 * ps AS thr FROM pt, pst
         WHERE ps > 0 AND psum < pm + 2 * ps AND pcnt >= 2 AND psum > 0),
  psel AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY
             {h13('acheteur_id', 'titulaire_id', salt=t + ':g')}) AS rn FROM pe) a, nn WHERE rn <= nn.n // 2),
  pr AS (SELECT c.uid, c.montant, s.thr, s.psum, s.acheteur_id, s.titulaire_id,
                row_number() OVER (PARTITION BY c.acheteur_id, c.titulaire_id
                                   ORDER BY {h13('c.uid', salt=t + ':r')}) AS rk
         FROM contracts c JOIN psel s USING (acheteur_id, titulaire_id))
  SELECT uid, CASE WHEN montant IS NOT NULL AND montant > 0 THEN montant * (thr * ({D(1.1)} +
           {u7('acheteur_id', 'titulaire_id', salt=t + ':f')} * {D(0.3)}) / psum) END AS nm FROM pr WHERE rk <= 2) x""",
                 montant="nm")


def rounded(cols_sql: str = "*") -> str:
    return ("SELECT uid, anomaly_type, type_code, slot, round(new_montant, 4) AS new_montant, new_offresRecues, "
            "new_procedure, round(new_dureeMois, 6) AS new_dureeMois, new_sousTraitanceDeclaree, new_titulaire_id, "
            "new_dateNotification FROM ")


def _round_spark(df):
    return df.withColumn("new_montant", F.round("new_montant", 4)).withColumn("new_dureeMois",
                                                                              F.round("new_dureeMois", 6))


def _make(tname: str):
    short = {"single_bid_competitive": "inject_single_bid", "price_inflation": "inject_price_inflation",
             "price_deflation": "inject_price_deflation", "procedure_manipulation": "inject_procedure",
             "suspicious_modifications": "inject_long_duration",
             "high_market_concentration": "inject_concentration",
             "temporal_clustering": "inject_temporal_cluster", "excessive_subcontracting": "inject_subcontracting",
             "short_contract_duration": "inject_short_duration",
             "suspicious_buyer_supplier_pairs": "inject_heavy_pairs"}[tname]

    @plan(short, with_contracts(rounded() + f"({T_SQL[tname]}) q", BASE), "2.11")
    def build(spark, sf):
        c = IJ.materialize(contracts(spark, sf).select(*IJ.inputs(P)))   # staged once, read by all sub-plans
        n = IJ.per_type_count(c, len(IJ.TYPES), P)
        return _round_spark(IJ.GENERATORS[tname](c, n, P))
    return build


for _t in IJ.TYPES:
    _make(_t)

ALL_CANDS = " UNION ALL ".join(f"({T_SQL[t]})" for t in IJ.TYPES)
ORDER_CASE = "CASE anomaly_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(IJ.TYPES)) + " END"
WIN_SQL = f"""cand AS ({ALL_CANDS}),
  win AS (SELECT uid, arg_max(struct_pack(anomaly_type := anomaly_type, type_code := type_code,
            {', '.join(f'new_{c} := new_{c}' for c in NEW)}), {ORDER_CASE} * 10 + slot) AS w FROM cand GROUP BY uid)"""


def _set(c: str) -> str:
    return f"CASE WHEN w.type_code IS NOT NULL AND w.new_{c} IS NOT NULL THEN w.new_{c} ELSE c.{c} END"


@plan("inject_replace", with_contracts(f"""
SELECT c.uid, round({_set('montant')}, 4) AS montant, {_set('offresRecues')} AS offresRecues,
       {_set('procedure')} AS procedure, round({_set('dureeMois')}, 6) AS dureeMois,
       {_set('sousTraitanceDeclaree')} AS sousTraitanceDeclaree, {_set('titulaire_id')} AS titulaire_id,
       {_set('dateNotification')} AS dateNotification, w.anomaly_type,
       coalesce(w.type_code, 0) AS is_synthetic_anomaly
FROM contracts c LEFT JOIN (SELECT uid, w.* FROM win) w ON c.uid = w.uid""", BASE + ",\n  " + WIN_SQL), "2.11")
def inject_replace(spark, sf):
    out = IJ.inject_replace(contracts(spark, sf).select(*IJ.inputs(P)), IJ.TYPES, P)
    return out.select("uid", F.round("montant", 4).alias("montant"), "offresRecues", "procedure",
                      F.round("dureeMois", 6).alias("dureeMois"), "sousTraitanceDeclaree", "titulaire_id",
                      "dateNotification", "anomaly_type", "is_synthetic_anomaly")


@plan("inject_append", with_contracts(f"""
SELECT uid, round(montant, 4) AS montant, dureeMois, is_synthetic_anomaly, anomaly_type, source_type FROM (
  SELECT uid, montant, round(dureeMois, 6) AS dureeMois, 0 AS is_synthetic_anomaly, NULL AS anomaly_type,
         NULL AS source_type FROM contracts
  UNION ALL
  SELECT q.uid || '#' || q.anomaly_type || '#' || CAST(q.slot AS VARCHAR), coalesce(q.new_montant, c.montant),
         round(coalesce(q.new_dureeMois, c.dureeMois), 6), q.type_code, q.anomaly_type, 'synthetic'
  FROM cand q JOIN contracts c USING (uid)) t""", BASE + ",\n  cand AS (" + ALL_CANDS + ")"), "2.11")
def inject_append(spark, sf):
    out = IJ.inject_append(contracts(spark, sf).select(*IJ.inputs(P)), IJ.TYPES, P)
    return out.select("uid", F.round("montant", 4).alias("montant"), F.round("dureeMois", 6).alias("dureeMois"),
                      "is_synthetic_anomaly", "anomaly_type", "source_type")


@plan("injection_summary", with_contracts(f"""
SELECT w.type_code AS is_synthetic_anomaly, w.anomaly_type AS anomaly_name, count(*) AS n_rows,
       round({D('count(*)')} * {D(100)} / {D('(SELECT count(*) FROM contracts)')}, 6) AS percentage
FROM (SELECT w.* FROM win) w GROUP BY 1, 2""", BASE + ",\n  " + WIN_SQL), "2.11")
def injection_summary(spark, sf):
    return IJ.injection_summary(IJ.inject_replace(contracts(spark, sf).select(*IJ.inputs(P)), IJ.TYPES, P))


@plan("labels_store", with_contracts(
    "SELECT uid, anomaly_type FROM (SELECT w.* , uid FROM win) t", BASE + ",\n  " + WIN_SQL), "2.1")
def labels_store(spark, sf):
    """Write the (uid, anomaly_type) label table to the shared folder, read it back."""
    lab = IJ.inject_replace(contracts(spark, sf).select(*IJ.inputs(P)), IJ.TYPES, P).filter(F.col("is_synthetic_anomaly") > 0) \
            .select("uid", "anomaly_type")
    path = scratch_path(spark, f"labels_{hashlib.md5(sf.encode()).hexdigest()[:8]}")
    lab.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
