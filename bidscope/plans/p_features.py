"""§2.9 feature pipeline plans (fit on the train split, transform)."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from bidscope.operators import clean as C
from bidscope.operators import features as FE
from bidscope.plans.oracle import cpv_level_sql, with_contracts
from bidscope.plans.registry import plan
from bidscope.session import scratch_path
from bidscope.sources.tables import contracts, contracts_staged

U42 = "(CAST(('0x' || substr(md5(uid || ':' || '42'), 1, 7)) AS BIGINT) / CAST(268435456 AS DOUBLE))"
PREP = f"""prep AS (SELECT *, {cpv_level_sql('codeCPV', 2)} AS codeCPV_2, {cpv_level_sql('codeCPV', 3)} AS codeCPV_3,
    CASE WHEN {cpv_level_sql('codeCPV', 2)} IN ('45000000', '71000000') THEN {cpv_level_sql('codeCPV', 3)}
         ELSE {cpv_level_sql('codeCPV', 2)} END AS codeCPV_2_3,
    CAST(TRY_CAST(substr(dateNotification, 1, 4) AS INTEGER) AS DOUBLE) AS annee,
    CASE WHEN tauxAvance > -0.001 AND tauxAvance <= 0.001 THEN 'no_advance'
         WHEN tauxAvance > 0.001 AND tauxAvance <= 0.05 THEN 'small_advance'
         WHEN tauxAvance > 0.05 AND tauxAvance <= 0.15 THEN 'medium_advance'
         WHEN tauxAvance > 0.15 AND tauxAvance <= 1.0 THEN 'large_advance' END AS tauxAvance_cat,
    {U42} AS u42 FROM contracts),
  train AS (SELECT * FROM prep WHERE u42 >= CAST(0.2 AS DOUBLE)),
  test AS (SELECT * FROM prep WHERE u42 < CAST(0.2 AS DOUBLE))"""


def _num_sql(c):
    imp = "med.m" if c == "offresRecues" else "CAST(0 AS DOUBLE)"
    return f"ln(1 + coalesce(CAST({c} AS DOUBLE), {imp}))"


def _fit_sql(spec: FE.FeatureSpec) -> str:
    stats = ", ".join(f"avg({_num_sql(c)}) AS m_{c}, stddev_pop({_num_sql(c)}) AS s_{c}" for c in spec.numerical)
    levels = " UNION ".join(f"SELECT DISTINCT '{c}' AS c, coalesce(CAST({c} AS VARCHAR), 'missing') AS v FROM train"
                            for c in spec.categorical)
    return (f"med AS (SELECT quantile_cont(offresRecues, 0.5) AS m FROM train),\n"
            f"  st AS (SELECT {stats} FROM train, med),\n  lv AS ({levels})")


def _name(c):
    return FE.FeatureModel.num_name(c)


def feature_long_sql(spec: FE.FeatureSpec, apply_to: str) -> str:
    parts = []
    for c in spec.numerical:
        parts.append(f"SELECT uid, '{_name(c)}' AS feature, round(({_num_sql(c)} - st.m_{c}) / "
                     f"CASE WHEN st.s_{c} = 0 OR st.s_{c} IS NULL THEN CAST(1 AS DOUBLE) ELSE st.s_{c} END, 6) AS value "
                     f"FROM {apply_to}, med, st")
    for c in spec.binary:
        v = (f"CAST({c} IS NOT NULL AS DOUBLE)" if c == "idAccordCadre"
             else f"coalesce(CAST({c} AS DOUBLE), CAST(0 AS DOUBLE))")
        parts.append(f"SELECT uid, 'binary_pipeline__{c}', {v} FROM {apply_to}")
    for c in spec.categorical:
        v = f"coalesce(CAST({c} AS VARCHAR), 'missing')"
        parts.append(f"SELECT uid, 'cat_pipeline__{c}_' || {v}, CAST(1 AS DOUBLE) FROM {apply_to} "
                     f"WHERE {v} IN (SELECT v FROM lv WHERE c = '{c}')")
    return with_contracts("\nUNION ALL ".join(parts), PREP + ",\n  " + _fit_sql(spec))


def _split(spark, sf):
    # fit (two passes + levels) and transform read it: stage the view once
    return C.split_random(FE.prepare(contracts_staged(spark, sf)), 0.2, 42)


def _fit_transform(spark, sf, spec, apply_split):
    d = _split(spark, sf)
    model = FE.fit(d.filter(F.col("split") == "train"), spec)
    out = model.transform_long(d.filter(F.col("split") == apply_split))
    return out.withColumn("value", F.round("value", 6))


ANOM = FE.preset("anomalie")


@plan("feature_pipeline", feature_long_sql(ANOM, "train"), "2.9")
def feature_pipeline(spark, sf):
    return _fit_transform(spark, sf, ANOM, "train")


@plan("fit_on_train", feature_long_sql(ANOM, "test"), "2.9")
def fit_on_train(spark, sf):
    return _fit_transform(spark, sf, ANOM, "test")


def _preset_names_sql() -> str:
    blocks = []
    for name, spec in FE.PRESETS.items():
        fixed = [FE.FeatureModel.num_name(c) for c in spec.numerical] + [f"binary_pipeline__{c}" for c in spec.binary]
        fixed_sql = " UNION ALL ".join(f"SELECT '{name}' AS preset, '{f}' AS feature" for f in fixed)
        cats = " UNION ALL ".join(
            f"SELECT DISTINCT '{name}', 'cat_pipeline__{c}_' || coalesce(CAST({c} AS VARCHAR), 'missing') FROM train"
            for c in spec.categorical)
        blocks.append(fixed_sql + " UNION ALL " + cats)
    return with_contracts(" UNION ALL ".join(blocks), PREP)


@plan("feature_presets", _preset_names_sql(), "2.9")
def feature_presets(spark, sf):
    """Output feature names of the three presets fitted on the train split."""
    d = _split(spark, sf).filter(F.col("split") == "train")
    frames = []
    for name in FE.PRESETS:
        spec = FE.preset(name)
        # names only: levels are the distinct train values (guarded count)
        lv = d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), FE._cat_input(c).alias("v"))
                                          for c in spec.categorical])).alias("l")).select("l.*").distinct()
        cat = lv.select(F.lit(name).alias("preset"), F.concat(F.lit("cat_pipeline__"), "c", F.lit("_"), "v")
                        .alias("feature"))
        fixed = [FE.FeatureModel.num_name(c) for c in spec.numerical] + [f"binary_pipeline__{c}" for c in spec.binary]
        fx = spark.createDataFrame([(name, f) for f in fixed], "preset string, feature string")
        frames.append(fx.unionByName(cat))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@plan("impute_median", with_contracts(
    "SELECT uid, coalesce(offresRecues, (SELECT quantile_cont(offresRecues, 0.5) FROM train)) AS offresRecues "
    "FROM prep", PREP), "2.9")
def impute_median(spark, sf):
    d = _split(spark, sf)
    return FE.impute_median(d.filter(F.col("split") == "train"), d, "offresRecues").select("uid", "offresRecues")


@plan("impute_constant", with_contracts("""
SELECT uid, coalesce(dureeMois, CAST(0 AS DOUBLE)) AS dureeMois, coalesce(tauxAvance, CAST(0 AS DOUBLE)) AS tauxAvance,
       coalesce(sousTraitanceDeclaree, CAST(0 AS DOUBLE)) AS sousTraitanceDeclaree,
       coalesce(idAccordCadre, 'missing') AS idAccordCadre, coalesce(tauxAvance_cat, 'missing') AS tauxAvance_cat
FROM prep""", PREP), "2.9")
def impute_constant(spark, sf):
    d = FE.prepare(contracts(spark, sf)).select("uid", "dureeMois", "tauxAvance", "sousTraitanceDeclaree",
                                                 "idAccordCadre", "tauxAvance_cat")
    return FE.impute_constant(d, ["dureeMois", "tauxAvance"], ["sousTraitanceDeclaree"],
                              ["idAccordCadre", "tauxAvance_cat"])


@plan("scale_standard", with_contracts("""
SELECT uid, round((montant - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) AS montant,
       round((dureeMois - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END, 6) AS dureeMois
FROM prep, (SELECT avg(montant) AS m1, stddev_pop(montant) AS s1, avg(dureeMois) AS m2, stddev_pop(dureeMois) AS s2
            FROM train) st""", PREP), "2.9")
def scale_standard(spark, sf):
    d = _split(spark, sf).select("uid", "montant", "dureeMois", "split")
    out = FE.scale_standard(d.filter(F.col("split") == "train"), d, ["montant", "dureeMois"])
    return out.select("uid", F.round("montant", 6).alias("montant"), F.round("dureeMois", 6).alias("dureeMois"))


@plan("scale_robust", with_contracts("""
SELECT uid, round((montant - q2) / CASE WHEN q3 - q1 = 0 THEN 1 ELSE q3 - q1 END, 9) AS montant
FROM prep, (SELECT quantile_cont(montant, 0.25) AS q1, quantile_cont(montant, 0.5) AS q2,
                   quantile_cont(montant, 0.75) AS q3 FROM train) q""", PREP), "2.9")
def scale_robust(spark, sf):
    d = _split(spark, sf).select("uid", "montant", "split")
    out = FE.scale_robust(d.filter(F.col("split") == "train"), d, "montant")
    return out.select("uid", F.round("montant", 9).alias("montant"))


FORME = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@plan("one_hot", with_contracts("SELECT uid, " + ", ".join(
    f"CASE WHEN coalesce(formePrix, 'missing') = '{lv}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END "
    f"AS cat_pipeline__formePrix_{lv}" for lv in FORME) + " FROM prep", PREP), "2.9")
def one_hot(spark, sf):
    d = _split(spark, sf).select("uid", "formePrix", "split")
    return FE.one_hot(d.filter(F.col("split") == "train"), d, "formePrix")


@plan("pipeline_store", feature_long_sql(ANOM, "test"), "2.1")
def pipeline_store(spark, sf):
    """Fit, persist to the shared folder, load back, transform the test split."""
    d = _split(spark, sf)
    model = FE.fit(d.filter(F.col("split") == "train"), ANOM)
    path = scratch_path(spark, f"feature_model_{hashlib.md5(sf.encode()).hexdigest()[:8]}")
    model.save(spark, path)
    loaded = FE.FeatureModel.load(spark, path)
    return loaded.transform_long(d.filter(F.col("split") == "test")).withColumn("value", F.round("value", 6))
