"""§2.13 evaluation plans over deterministic predictions (dummy-median
baseline, z-score detector, injected labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.functions.columns import bin_ranges
from bidscope.operators import clean as C
from bidscope.operators import evaluate as EV
from bidscope.operators import graph as G
from bidscope.operators import inject as IJ
from bidscope.operators.quantiles import exact_quantile_row, exact_quantiles
from bidscope.plans import p_inject as PI
from bidscope.plans.oracle import with_contracts
from bidscope.plans.registry import plan
from bidscope.session import stage_small as stage
from bidscope.sources.tables import contracts, contracts_staged

U42 = "(CAST(('0x' || substr(md5(uid || ':' || '42'), 1, 7)) AS BIGINT) / CAST(268435456 AS DOUBLE))"


def bin_sql(x: str) -> str:
    return (f"CASE WHEN {x} >= 0 AND {x} < 25000 THEN 0 WHEN {x} >= 25000 AND {x} < 90000 THEN 1 "
            f"WHEN {x} >= 90000 AND {x} < 221000 THEN 2 WHEN {x} >= 221000 AND {x} < 1000000 THEN 3 ELSE 4 END")


SPLIT = f"""sp AS (SELECT *, {U42} AS u42 FROM contracts),
  train AS (SELECT * FROM sp WHERE u42 >= CAST(0.2 AS DOUBLE)),
  test AS (SELECT * FROM sp WHERE u42 < CAST(0.2 AS DOUBLE)),
  dm AS (SELECT categorie, quantile_cont(montant, 0.5) AS med FROM train GROUP BY 1),
  pr AS (SELECT t.uid, t.categorie, {bin_sql('t.montant')} AS label, {bin_sql('dm.med')} AS pred
         FROM test t JOIN dm USING (categorie))"""


def _pred(spark, sf):
    d = C.split_random(contracts(spark, sf), 0.2, 42)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    med = exact_quantiles(train, "montant", [0.5], ["med"], ["categorie"])
    return test.join(med, "categorie").select("uid", "categorie", bin_ranges("montant").alias("label"),
                                              bin_ranges("med").alias("pred"))


@plan("confusion", with_contracts("SELECT label, pred, count(*) AS n FROM pr GROUP BY 1, 2", SPLIT), "2.13")
def confusion(spark, sf):
    return EV.confusion(_pred(spark, sf), "label", "pred")


CLASS_SQL = """c AS (SELECT label, pred, count(*) AS n FROM pr GROUP BY 1, 2),
  sup AS (SELECT label, sum(n) AS support FROM c GROUP BY 1),
  npr AS (SELECT pred AS label, sum(n) AS npred FROM c GROUP BY 1),
  tp AS (SELECT label, sum(n) AS tp FROM c WHERE label = pred GROUP BY 1),
  per AS (SELECT coalesce(sup.label, npr.label) AS label, coalesce(tp.tp, 0) AS tp, coalesce(support, 0) AS support,
                 coalesce(npred, 0) AS npred
          FROM sup FULL JOIN npr ON sup.label = npr.label LEFT JOIN tp ON tp.label = coalesce(sup.label, npr.label)),
  p2 AS (SELECT CAST(label AS VARCHAR) AS class,
                CASE WHEN npred = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / CAST(npred AS DOUBLE) END AS precision,
                CASE WHEN support = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) END AS recall,
                CAST(support AS BIGINT) AS support FROM per),
  p3 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END
                AS f1 FROM p2),
  tt AS (SELECT sum(support) AS tot FROM p3)"""


@plan("class_report", with_contracts("""
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, support, round(f1, 9) AS f1 FROM (
  SELECT class, precision, recall, support, f1 FROM p3
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), CAST(sum(support) AS BIGINT), avg(f1) FROM p3
  UNION ALL SELECT 'weighted avg', sum(precision * support / tot), sum(recall * support / tot),
                   CAST(sum(support) AS BIGINT), sum(f1 * support / tot) FROM p3, tt
  UNION ALL SELECT 'accuracy', a, a, CAST(n AS BIGINT), a FROM (
    SELECT CAST(sum(CASE WHEN label = pred THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS a, sum(n) AS n
    FROM c) x) r""", SPLIT + ",\n  " + CLASS_SQL), "2.13")
def class_report(spark, sf):
    r = EV.class_report(_pred(spark, sf), "label", "pred")
    return r.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall")],
                    F.col("support").cast("bigint").alias("support"), F.round("f1", 9).alias("f1"))


@plan("accuracy_by_category", with_contracts("""
SELECT categorie, round(avg(CAST(label = pred AS DOUBLE)), 9) AS accuracy, count(*) AS n FROM pr GROUP BY 1
HAVING avg(CAST(label = pred AS DOUBLE)) > CAST(0.1 AS DOUBLE)""", SPLIT), "2.13")
def accuracy_by_category(spark, sf):
    a = EV.accuracy_by_category(_pred(spark, sf), "categorie", "label", "pred", 0.1)
    return a.select("categorie", F.round("accuracy", 9).alias("accuracy"), "n")


DUMMY_SQL = """gm AS (SELECT quantile_cont(montant, 0.5) AS med FROM train),
  rr AS (SELECT t.montant AS y, gm.med AS yhat FROM test t, gm WHERE t.montant IS NOT NULL)"""


def _dummy(spark, sf):
    d = C.split_random(contracts(spark, sf), 0.2, 42)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    med = exact_quantile_row(train, "montant", [0.5], ["yhat"])
    return test.filter(F.col("montant").isNotNull()).crossJoin(F.broadcast(med))


@plan("dummy_median", with_contracts(
    "SELECT t.uid, round(gm.med, 6) AS prediction FROM test t, gm", SPLIT + ",\n  " + DUMMY_SQL), "2.13")
def dummy_median(spark, sf):
    d = C.split_random(contracts(spark, sf), 0.2, 42)
    med = exact_quantile_row(d.filter(F.col("split") == "train"), "montant", [0.5], ["prediction"])
    return d.filter(F.col("split") == "test").crossJoin(F.broadcast(med)) \
            .select("uid", F.round("prediction", 6).alias("prediction"))


@plan("regression_report", with_contracts("""
SELECT round(avg(abs(yhat - y)), 2) AS mae, round(sqrt(avg((yhat - y) * (yhat - y))), 2) AS rmse,
       round(1 - sum((yhat - y) * (yhat - y)) / sum((y - (SELECT avg(y) FROM rr)) * (y - (SELECT avg(y) FROM rr))), 9)
         AS r2,
       round(avg(CASE WHEN y <> 0 THEN abs(yhat - y) / abs(y) * 100 END), 6) AS mape,
       round(quantile_cont(CASE WHEN y <> 0 THEN abs(yhat - y) / abs(y) * 100 END, 0.5), 6) AS mdape FROM rr""",
    SPLIT + ",\n  " + DUMMY_SQL), "2.13")
def regression_report(spark, sf):
    r = EV.regression_report(_dummy(spark, sf), "montant", "yhat")
    return r.select(F.round("mae", 2).alias("mae"), F.round(F.sqrt("mse"), 2).alias("rmse"),
                    F.round("r2", 9).alias("r2"), F.round("mape", 6).alias("mape"), F.round("mdape", 6).alias("mdape"))


# --- detector = |z| of the amount inside its category; label = rule flag ------
ZSQL = """st AS (SELECT categorie, avg(montant) AS m, stddev_samp(montant) AS sd, count(*) AS n FROM contracts
                 WHERE montant IS NOT NULL AND categorie IS NOT NULL GROUP BY 1),
  sc AS (SELECT c.uid, abs(c.montant - st.m) / st.sd AS z,
                CAST(coalesce(st.n >= 200 AND st.sd > 0 AND c.montant > st.m + 3 * st.sd, false) AS INTEGER) AS label
         FROM contracts c JOIN st USING (categorie))"""


def _scored(spark, sf):
    c = contracts_staged(spark, sf, ["categorie", "montant"])
    # written: a score is the same at every pass over it
    st = stage(c.filter(F.col("montant").isNotNull()).groupBy("categorie").agg(
        F.avg("montant").alias("_m"), F.stddev_samp("montant").alias("_sd"), F.count(F.lit(1)).alias("_n")), "category-stats")
    j = c.join(st, "categorie")
    lab = F.coalesce((F.col("_n") >= 200) & (F.col("_sd") > 0) & (F.col("montant") > F.col("_m") + 3 * F.col("_sd")),
                     F.lit(False)).cast("int")
    return j.select((F.abs(F.col("montant") - F.col("_m")) / F.col("_sd")).alias("z"), lab.alias("label"))


@plan("roc_auc", with_contracts("""
SELECT round(sum(pos * (nb + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 9) AS roc_auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM (
  SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM (SELECT z AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
        FROM sc WHERE z IS NOT NULL GROUP BY 1) a) b""", ZSQL), "2.13")
def roc_auc(spark, sf):
    r = EV.roc_auc(_scored(spark, sf), "label", "z")
    return r.select(F.round("roc_auc", 9).alias("roc_auc"), "n_pos", "n_neg")


@plan("threshold_sweep", with_contracts("""
SELECT percentile, round(threshold, 6) AS threshold, tp, fp, fn, tn,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END, 9) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END, 9) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE
         2 * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) * (CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE))
         / ((CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) + (CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE))) END, 9)
         AS f1
FROM (SELECT p.percentile, p.threshold,
             count(*) FILTER (WHERE z > p.threshold AND label = 1) AS tp,
             count(*) FILTER (WHERE z > p.threshold AND label = 0) AS fp,
             count(*) FILTER (WHERE NOT (z > p.threshold) AND label = 1) AS fn,
             count(*) FILTER (WHERE NOT (z > p.threshold) AND label = 0) AS tn
      FROM sc, (""" + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS percentile, quantile_cont(z, {p / 100}) AS threshold FROM sc"
    for p in (95.0, 97.0, 99.0, 99.5)) + """) p
      GROUP BY 1, 2) t""", ZSQL), "2.13")
def threshold_sweep(spark, sf):
    r = EV.threshold_sweep(_scored(spark, sf), "label", "z")
    return r.select("percentile", F.round("threshold", 6).alias("threshold"), "tp", "fp", "fn", "tn",
                    *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


# --- injected labels + detector on the injected table -----------------------
INJ_SQL = PI.BASE + ",\n  " + PI.WIN_SQL + """,
  inj AS (SELECT c.uid, c.categorie,
                 CASE WHEN w.type_code IS NOT NULL AND w.new_montant IS NOT NULL THEN w.new_montant ELSE c.montant END
                   AS montant, coalesce(w.type_code, 0) AS t
          FROM contracts c LEFT JOIN (SELECT uid, w.* FROM win) w ON c.uid = w.uid),
  ist AS (SELECT categorie, avg(montant) AS m, stddev_samp(montant) AS sd FROM inj GROUP BY 1),
  iz AS (SELECT i.uid, i.t, abs(i.montant - ist.m) / ist.sd AS z FROM inj i JOIN ist USING (categorie)),
  ithr AS (SELECT quantile_cont(z, 0.95) AS thr FROM iz WHERE z IS NOT NULL),
  det AS (SELECT iz.*, coalesce(z > ithr.thr, false) AS flag FROM iz, ithr)"""


def _detected(spark, sf):
    inj = stage(IJ.inject_replace(contracts(spark, sf).select(*IJ.inputs(PI.P)), IJ.TYPES, PI.P)
                  .select("categorie", "montant", "is_synthetic_anomaly"), "injected")
    st = stage(inj.groupBy("categorie").agg(F.avg("montant").alias("_m"), F.stddev_samp("montant").alias("_sd")), "category-stats")
    z = inj.join(st, "categorie").select(F.col("is_synthetic_anomaly").alias("t"),
                                          (F.abs(F.col("montant") - F.col("_m")) / F.col("_sd")).alias("z"))
    return G.threshold_flag(z, "z", 5.0, written=True).withColumnRenamed("is_anomaly", "flag")


@plan("detection_by_type", with_contracts("""
SELECT t, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100 / CAST((SELECT count(*) FROM det) AS DOUBLE), 6)
         AS dataset_pct, round(avg(CAST(flag AS DOUBLE)), 9) AS rate, round(avg(CAST(flag AS DOUBLE)) / 0.05, 9) AS factor,
       CASE WHEN t = 0 THEN CASE WHEN avg(CAST(flag AS DOUBLE)) < 0.05 THEN 'Good'
                                 WHEN avg(CAST(flag AS DOUBLE)) < 0.1 THEN 'High FP' ELSE 'Very High FP' END
            WHEN avg(CAST(flag AS DOUBLE)) / 0.05 > 2 THEN 'Excellent'
            WHEN avg(CAST(flag AS DOUBLE)) / 0.05 > 1.5 THEN 'Good'
            WHEN avg(CAST(flag AS DOUBLE)) / 0.05 > 0.8 THEN 'Weak' ELSE 'Poor' END AS status
FROM det GROUP BY t""", INJ_SQL), "2.13")
def detection_by_type(spark, sf):
    d = EV.detection_by_type(_detected(spark, sf), "t", "flag", 5.0)
    return d.select("t", "count", F.round("dataset_pct", 6).alias("dataset_pct"), F.round("rate", 9).alias("rate"),
                    F.round("factor", 9).alias("factor"), "status")


@plan("error_stats_by_type", with_contracts("""
SELECT t, count(*) AS count, round(avg(z), 6) AS mean_error, round(stddev_pop(z), 6) AS std_error,
       round(avg(CAST(flag AS DOUBLE)), 9) AS detection_rate, round(quantile_cont(z, 0.5), 6) AS median_error
FROM det GROUP BY t""", INJ_SQL), "2.4")
def error_stats_by_type(spark, sf):
    e = EV.error_stats_by_type(_detected(spark, sf), "t", "z", "flag")
    return e.select("t", "count", F.round("mean_error", 6).alias("mean_error"),
                    F.round("std_error", 6).alias("std_error"), F.round("detection_rate", 9).alias("detection_rate"),
                    F.round("median_error", 6).alias("median_error"))




@plan("label_join", with_contracts(f"""
SELECT pr.uid, pr.label, pr.pred, CAST(pr.label = pr.pred AS INTEGER) AS correct, t.montant
FROM pr JOIN test t USING (uid)""", SPLIT), "2.3")
def label_join(spark, sf):
    """Predictions aligned to their rows by ``uid`` (never by position)."""
    d = C.split_random(contracts(spark, sf), 0.2, 42).filter(F.col("split") == "test").select("uid", "montant")
    p = _pred(spark, sf)
    return p.join(d, "uid").select("uid", "label", "pred", (F.col("label") == F.col("pred")).cast("int")
                                    .alias("correct"), "montant")
