"""§2.8 scalar functions."""

from __future__ import annotations


from pyspark.sql import functions as F

from bidscope.functions import columns as FN
from bidscope.operators.quantiles import exact_quantiles
from bidscope.plans.oracle import cpv_level_sql, with_contracts
from bidscope.plans.registry import plan
from bidscope.sources.tables import contracts, read_table


@plan("cpv_level", with_contracts(f"SELECT uid, codeCPV, {cpv_level_sql('codeCPV', 2)} AS codeCPV_2 FROM contracts"),
      "2.8")
def cpv_level(spark, sf):
    c = contracts(spark, sf)
    return c.select("uid", "codeCPV", FN.cpv_level("codeCPV", 2).alias("codeCPV_2"))


@plan("cpv_levels", with_contracts("SELECT uid, " + ", ".join(
    f"{cpv_level_sql('codeCPV', lv)} AS codeCPV_{lv}" for lv in (2, 3, 4, 5)) + " FROM contracts"), "2.8")
def cpv_levels(spark, sf):
    c = contracts(spark, sf)
    return c.select("uid", *[FN.cpv_level("codeCPV", lv).alias(f"codeCPV_{lv}") for lv in (2, 3, 4, 5)])


@plan("cpv_2_3", with_contracts(f"""
SELECT uid, CASE WHEN {cpv_level_sql('codeCPV', 2)} IN ('45000000', '71000000') THEN {cpv_level_sql('codeCPV', 3)}
                 ELSE {cpv_level_sql('codeCPV', 2)} END AS codeCPV_2_3 FROM contracts"""), "2.8")
def cpv_2_3(spark, sf):
    return contracts(spark, sf).select("uid", FN.cpv_2_3("codeCPV").alias("codeCPV_2_3"))


@plan("str_functions", with_contracts("""
SELECT uid, split_part(trim(codeCPV), '-', 1) AS code_digits, starts_with(codeCPV, '45') AS is_works,
       substr(codeCPV, 1, 4) AS code_prefix, replace(formePrix, 'A', '_') AS forme_replaced,
       upper(substr(ccag, 1, 1)) || lower(substr(ccag, 2)) AS ccag_title,
       CASE WHEN length(procedure) > 10 THEN substr(procedure, 1, 10) || '...' ELSE procedure END AS procedure_short,
       acheteur_id || '/' || titulaire_id AS pair_label FROM contracts"""), "2.8")
def str_functions(spark, sf):
    c = contracts(spark, sf)
    return c.select(
        "uid",
        F.split_part(F.trim("codeCPV"), F.lit("-"), F.lit(1)).alias("code_digits"),
        F.startswith("codeCPV", F.lit("45")).alias("is_works"),
        F.substring("codeCPV", 1, 4).alias("code_prefix"),
        F.replace("formePrix", F.lit("A"), F.lit("_")).alias("forme_replaced"),
        FN.title_name("ccag").alias("ccag_title"),
        FN.truncate_label("procedure", 10).alias("procedure_short"),
        F.concat_ws("/", "acheteur_id", "titulaire_id").alias("pair_label"))


@plan("feature_label", with_contracts("""
SELECT DISTINCT name, regexp_extract(name, '^([a-z_]+)__([A-Za-z]+)_(.*)$', 1) AS step,
       regexp_extract(name, '^([a-z_]+)__([A-Za-z]+)_(.*)$', 2) AS feature,
       regexp_extract(name, '^([a-z_]+)__([A-Za-z]+)_(.*)$', 3) AS level, readable
FROM (SELECT 'cat_pipeline__formePrix_' || formePrix AS name, 'Forme prix: ' || formePrix AS readable FROM contracts
      UNION ALL SELECT 'cat_pipeline__ccag_' || ccag, 'CCAG: ' || ccag FROM contracts
      UNION ALL SELECT 'cat_pipeline__nature_' || nature, 'Nature: ' || nature FROM contracts
      UNION ALL SELECT 'cat_pipeline__typeGroupementOperateurs_' || typeGroupementOperateurs,
                       'cat_pipeline__typeGroupementOperateurs_' || typeGroupementOperateurs FROM contracts) t"""), "2.8")
def feature_label(spark, sf):
    c = contracts(spark, sf)
    columns = ["formePrix", "ccag", "nature", "typeGroupementOperateurs"]
    names = c.select(F.explode(F.array(*[F.concat(F.lit(f"cat_pipeline__{x}_"), x) for x in columns])).alias("name")).filter("name IS NOT NULL").distinct()
    pat = r"^([a-z_]+)__([A-Za-z]+)_(.*)$"
    return names.select("name", F.regexp_extract("name", pat, 1).alias("step"),
                        F.regexp_extract("name", pat, 2).alias("feature"),
                        F.regexp_extract("name", pat, 3).alias("level"), FN.readable_feature(F.col("name")).alias("readable"))


@plan("cast_string", with_contracts("""
SELECT uid, CAST(CAST(offresRecues AS INTEGER) AS VARCHAR) AS offres_str,
       CAST(CAST(sousTraitanceDeclaree AS INTEGER) AS VARCHAR) AS sous_traitance_str FROM contracts"""), "2.8")
def cast_string(spark, sf):
    c = contracts(spark, sf)
    return c.select("uid", F.col("offresRecues").cast("int").cast("string").alias("offres_str"),
                    F.col("sousTraitanceDeclaree").cast("int").cast("string").alias("sous_traitance_str"))


@plan("date_parse", with_contracts("""
SELECT uid, TRY_CAST(dateNotification AS DATE) AS date_notification FROM contracts"""), "2.8")
def date_parse(spark, sf):
    return contracts(spark, sf).select("uid", FN.parse_date("dateNotification").alias("date_notification"))


@plan("date_arith", with_contracts("""
SELECT uid, CAST(date_diff('day', DATE '1995-01-01', d) AS INTEGER) AS days_since_1995,
       strftime(d + INTERVAL 30 DAY, '%Y-%m-%d') AS plus_30_days, CAST(year(d) AS INTEGER) AS year
FROM (SELECT uid, TRY_CAST(dateNotification AS DATE) AS d FROM contracts) t"""), "2.8")
def date_arith(spark, sf):
    d = FN.parse_date("dateNotification")
    return contracts(spark, sf).select(
        "uid", F.datediff(d, F.lit("1995-01-01").cast("date")).alias("days_since_1995"),
        F.date_format(F.date_add(d, 30), "yyyy-MM-dd").alias("plus_30_days"), F.year(d).alias("year"))


@plan("notnull_flag", with_contracts(
    "SELECT uid, CAST(idAccordCadre IS NOT NULL AS INTEGER) AS has_framework FROM contracts"), "2.8")
def notnull_flag(spark, sf):
    return contracts(spark, sf).select("uid", FN.notnull_flag("idAccordCadre").alias("has_framework"))


@plan("bin_fixed", with_contracts("""
SELECT uid, tauxAvance, CASE WHEN tauxAvance > -0.001 AND tauxAvance <= 0.001 THEN 'no_advance'
  WHEN tauxAvance > 0.001 AND tauxAvance <= 0.05 THEN 'small_advance'
  WHEN tauxAvance > 0.05 AND tauxAvance <= 0.15 THEN 'medium_advance'
  WHEN tauxAvance > 0.15 AND tauxAvance <= 1.0 THEN 'large_advance' END AS tauxAvance_cat FROM contracts"""), "2.8")
def bin_fixed(spark, sf):
    return contracts(spark, sf).select("uid", "tauxAvance", FN.bin_fixed("tauxAvance").alias("tauxAvance_cat"))


LOG_BINS_SQL = """lg AS (SELECT uid, ln(1 + montant) AS y FROM contracts WHERE montant IS NOT NULL),
  mm AS (SELECT min(y) AS lo, max(y) AS hi FROM lg)"""


@plan("bin_log_equal", with_contracts("""
SELECT uid, CAST(greatest(b - 1, 0) AS INTEGER) AS amount_class, CAST(b AS INTEGER) AS bin9 FROM (
  SELECT uid, least(greatest(CAST(ceil((y - lo) / ((hi - lo) / CAST(9 AS DOUBLE))) AS BIGINT) - 1, 0), 8) AS b
  FROM lg, mm) t""", LOG_BINS_SQL), "2.8")
def bin_log_equal(spark, sf):
    """log1p amount cut into 9 equal-width bins, then the second edge is
    removed: classes 0..7 (``greatest(bin-1, 0)``)."""
    c = contracts(spark, sf).filter(F.col("montant").isNotNull()).select("uid", F.log1p("montant").alias("y"))
    mm = c.agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    j = c.crossJoin(F.broadcast(mm))  # one row
    b = FN.bin_equal_width("y", F.col("lo"), F.col("hi"), 9)
    return j.select("uid", F.greatest(b - 1, F.lit(0)).cast("int").alias("amount_class"), b.alias("bin9"))


@plan("bin_log_100", with_contracts("""
SELECT uid, CAST(least(greatest(CAST(ceil((y - lo) / ((hi - lo) / CAST(100 AS DOUBLE))) AS BIGINT) - 1, 0), 99) AS INTEGER) AS bin100
FROM (SELECT uid, ln(1 + montant) AS y FROM contracts WHERE montant <= 999999) a,
     (SELECT min(ln(1 + montant)) AS lo, max(ln(1 + montant)) AS hi FROM contracts WHERE montant <= 999999) b"""), "2.8")
def bin_log_100(spark, sf):
    """log1p amounts up to 999,999 in 100 bins of equal width."""
    c = contracts(spark, sf).filter("montant <= 999999").select("uid", F.log1p("montant").alias("y"))
    mm = c.agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    j = c.crossJoin(F.broadcast(mm))  # one row
    return j.select("uid", FN.bin_equal_width("y", F.col("lo"), F.col("hi"), 100).cast("int").alias("bin100"))


@plan("bin_quantile", with_contracts("""
SELECT c.uid, CAST((c.montant > q.q1)::INT + (c.montant > q.q2)::INT + (c.montant > q.q3)::INT
     + (c.montant > q.q4)::INT + (c.montant > q.q5)::INT + (c.montant > q.q6)::INT + (c.montant > q.q7)::INT
     AS INTEGER) AS qbin
FROM contracts c, (SELECT """ + ", ".join(f"quantile_cont(montant, {k}/8) AS q{k}" for k in range(1, 8)) +
    """ FROM contracts) q WHERE c.montant IS NOT NULL"""), "2.8")
def bin_quantile(spark, sf):
    """``qcut(q=8)``: right-closed bins on exact octiles; ties share a bin."""
    c = contracts(spark, sf).filter(F.col("montant").isNotNull()).select("uid", "montant")
    names = [f"q{k}" for k in range(1, 8)]
    q = exact_quantiles(c, "montant", [k / 8 for k in range(1, 8)], names)
    j = c.crossJoin(F.broadcast(q))  # one row
    b = sum(((F.col("montant") > F.col(n)).cast("int") for n in names[1:]), (F.col("montant") > F.col("q1")).cast("int"))
    return j.select("uid", b.cast("int").alias("qbin"))


@plan("bin_ranges", with_contracts("""
SELECT uid, CASE WHEN montant >= 0 AND montant < 25000 THEN 0 WHEN montant >= 25000 AND montant < 90000 THEN 1
  WHEN montant >= 90000 AND montant < 221000 THEN 2 WHEN montant >= 221000 AND montant < 1000000 THEN 3
  ELSE 4 END AS amount_range FROM contracts"""), "2.8")
def bin_ranges(spark, sf):
    return contracts(spark, sf).select("uid", FN.bin_ranges("montant").alias("amount_range"))


RANGES_SQL = """rng AS (SELECT * FROM (VALUES (0, CAST(0 AS DOUBLE), CAST(25000 AS DOUBLE)),
  (1, CAST(25000 AS DOUBLE), CAST(90000 AS DOUBLE)), (2, CAST(90000 AS DOUBLE), CAST(221000 AS DOUBLE)),
  (3, CAST(221000 AS DOUBLE), CAST(1000000 AS DOUBLE)), (4, CAST(1000000 AS DOUBLE), CAST('inf' AS DOUBLE)))
  AS r(amount_range, range_lo, range_hi))"""


@plan("range_lookup", with_contracts("""
SELECT c.uid, coalesce(r.range_lo, l.range_lo) AS range_lo, coalesce(r.range_hi, l.range_hi) AS range_hi
FROM (SELECT uid, CAST(offresRecues AS INTEGER) - 1 AS cls FROM contracts) c
LEFT JOIN rng r ON c.cls = r.amount_range CROSS JOIN (SELECT * FROM rng WHERE amount_range = 4) l""", RANGES_SQL),
    "2.8")
def range_lookup(spark, sf):
    """class → (lo, hi) through a 5-row table; unknown class → last range.
    The class here is ``offresRecues - 1`` (0..6, null), so 5, 6 and null
    exercise the fallback."""
    rng = spark.createDataFrame([(i, float(lo), float(hi)) for i, (lo, hi) in enumerate(FN.AMOUNT_RANGES)],
                                "amount_range int, range_lo double, range_hi double")
    last = rng.filter(F.col("amount_range") == len(FN.AMOUNT_RANGES) - 1) \
              .select(F.col("range_lo").alias("_llo"), F.col("range_hi").alias("_lhi"))
    c = contracts(spark, sf).select("uid", (F.col("offresRecues").cast("int") - 1).alias("cls"))
    j = c.join(F.broadcast(rng), c.cls == rng.amount_range, "left").crossJoin(F.broadcast(last))
    return j.select("uid", F.coalesce("range_lo", "_llo").alias("range_lo"),
                    F.coalesce("range_hi", "_lhi").alias("range_hi"))


@plan("bin_centers", with_contracts("""
SELECT k AS bin, round(exp(lo + (hi - lo) / CAST(9 AS DOUBLE) * (CAST(k AS DOUBLE) + CAST(0.5 AS DOUBLE))) - 1, 4)
       AS center_amount
FROM mm, range(0, 9) t(k)""".replace("range(0, 9) t(k)", "(SELECT CAST(range AS INTEGER) AS k FROM range(0, 9)) t"),
    LOG_BINS_SQL), "2.8")
def bin_centers(spark, sf):
    c = contracts(spark, sf).filter(F.col("montant").isNotNull()).select(F.log1p("montant").alias("y"))
    mm = c.agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    ks = spark.range(9).select(F.col("id").cast("int").alias("bin"))
    w = (F.col("hi") - F.col("lo")) / F.lit(9.0)
    center = F.exp(F.col("lo") + w * (F.col("bin").cast("double") + F.lit(0.5))) - F.lit(1.0)
    return mm.crossJoin(ks).select("bin", F.round(center, 4).alias("center_amount"))


@plan("log_transform", with_contracts("""
SELECT uid, round(ln(1 + montant), 9) AS log_montant,
       round(exp(least(greatest(ln(1 + montant), CAST(0 AS DOUBLE)), CAST(20 AS DOUBLE))) - 1, 4) AS back_montant
FROM contracts"""), "2.8")
def log_transform(spark, sf):
    c = contracts(spark, sf)
    y = F.log1p("montant")
    return c.select("uid", F.round(y, 9).alias("log_montant"),
                    F.round(FN.log1p_clip_inverse(y), 4).alias("back_montant"))


@plan("fill_values", with_contracts("""
SELECT uid, coalesce(offresRecues, CAST(1 AS DOUBLE)) AS offresRecues, coalesce(tauxAvance, CAST(0 AS DOUBLE))
       AS tauxAvance, coalesce(dureeMois, CAST(2 AS DOUBLE)) AS dureeMois, coalesce(idAccordCadre, 'missing')
       AS idAccordCadre FROM contracts"""), "2.8")
def fill_values(spark, sf):
    c = contracts(spark, sf).select("uid", "offresRecues", "tauxAvance", "dureeMois", "idAccordCadre")
    return c.fillna({"offresRecues": 1.0, "tauxAvance": 0.0, "dureeMois": 2.0, "idAccordCadre": "missing"})


@plan("vector_math", """
WITH e AS (SELECT vec_id, label, CAST(v AS DOUBLE) AS v, CAST(pos AS INTEGER) AS pos FROM (
             SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) a),
c AS (SELECT label, pos, avg(v) AS cv FROM e GROUP BY 1, 2),
am AS (SELECT vec_id, arg_max(pos, v) AS argmax_pos FROM (SELECT vec_id, pos, v FROM e) z GROUP BY 1)
SELECT e.vec_id, round(avg((e.v - c.cv) * (e.v - c.cv)), 9) AS mse_to_centroid,
       round(sqrt(sum((e.v - c.cv) * (e.v - c.cv))), 9) AS l2_to_centroid,
       round(sum(e.v * e.v), 9) AS sq_norm, min(am.argmax_pos) AS argmax_pos
FROM e JOIN c USING (label, pos) JOIN am USING (vec_id) GROUP BY e.vec_id""", "2.8")
def vector_math(spark, sf):
    """Per embedding: mean squared error and L2 distance to its label's
    centroid, squared norm, 1-based arg-max position.  Vectors are exploded
    to (id, pos, value) so centroids are ordinary distributed aggregates."""
    emb = read_table(spark, sf, "embeddings", ["vec_id", "label", "embedding"])
    e = emb.select("vec_id", "label", F.posexplode("embedding").alias("pos0", "v")) \
           .select("vec_id", "label", (F.col("pos0") + 1).cast("int").alias("pos"), F.col("v").cast("double").alias("v"))
    cen = e.groupBy("label", "pos").agg(F.avg("v").alias("cv"))
    d2 = (F.col("v") - F.col("cv")) * (F.col("v") - F.col("cv"))
    per = e.join(cen, ["label", "pos"]).groupBy("vec_id").agg(
        F.round(F.avg(d2), 9).alias("mse_to_centroid"), F.round(F.sqrt(F.sum(d2)), 9).alias("l2_to_centroid"),
        F.round(F.sum(F.col("v") * F.col("v")), 9).alias("sq_norm"),
        F.max_by("pos", F.struct("v", -F.col("pos"))).alias("argmax_pos"))
    return per


_PREVALENCE_OF = {
    "typeGroupementOperateurs": "typeGroupementOperateurs", "offresRecues": "CAST(CAST(offresRecues AS INTEGER) AS VARCHAR)",
    "codeCPV_3": cpv_level_sql("codeCPV", 3)}


@plan("status_bucket", with_contracts("""
SELECT col, value, round(p, 6) AS prevalence, CASE WHEN p > 10 THEN 'Very High' WHEN p > 5 THEN 'High'
       WHEN p > 1 THEN 'Medium' WHEN p > CAST(0.1 AS DOUBLE) THEN 'Low' ELSE 'Very Low' END AS status FROM (
  SELECT col, value, CAST(count(*) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST((SELECT count(*) FROM contracts) AS DOUBLE) AS p
  FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS col, {x} AS value FROM contracts" for c, x in _PREVALENCE_OF.items()) + """) a
  WHERE value IS NOT NULL GROUP BY 1, 2) t"""), "2.8")
def status_bucket(spark, sf):
    """Prevalence of the values of three columns; their shares reach all five
    buckets."""
    c = contracts(spark, sf)
    pairs = F.explode(F.array(
        F.struct(F.lit("typeGroupementOperateurs").alias("col"), F.col("typeGroupementOperateurs").alias("value")),
        F.struct(F.lit("offresRecues").alias("col"), F.col("offresRecues").cast("int").cast("string").alias("value")),
        F.struct(F.lit("codeCPV_3").alias("col"), FN.cpv_level("codeCPV", 3).alias("value"))))
    counts = c.select(pairs.alias("_p")).select("_p.col", "_p.value").groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    total = c.agg(F.count(F.lit(1)).alias("_t"))
    p = FN.pct("n", "_t")
    return counts.filter("value IS NOT NULL").crossJoin(F.broadcast(total)).select(
        "col", "value", F.round(p, 6).alias("prevalence"), FN.prevalence_status(p).alias("status"))
