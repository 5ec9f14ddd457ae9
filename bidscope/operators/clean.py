"""Projections, filters and row selection.

All filters are plain predicates so Catalyst pushes them below the joins of
the contract view and, where they touch a base column, into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.columns import dbl, md5_key, md5_uniform, year_of
from bidscope.operators.quantiles import hash_rank_value, hash_statistics
from bidscope.session import stage_small as stage


def select_columns(df: DataFrame, numeric: Sequence[str] = (), binary: Sequence[str] = (),
                   categorical: Sequence[str] = (), keep: Sequence[str] = ("uid",)) -> DataFrame:
    cols = list(dict.fromkeys([*keep, *numeric, *binary, *categorical]))
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def filter_amount(df: DataFrame, lo: float = 20000.0, hi: float = 5e7, col: str = "montant") -> DataFrame:
    """Drop amounts outside [lo, hi]; a null amount is kept (NaN compares false)."""
    c = F.col(col)
    return df.filter(c.isNull() | c.between(dbl(lo), dbl(hi)))


def filter_duration(df: DataFrame, max_months: float = 900.0, col: str = "dureeMois") -> DataFrame:
    """Drop durations above ``max_months`` and null durations."""
    return df.filter(F.col(col) <= dbl(max_months))


def filter_year(df: DataFrame, lo_exclusive: int, hi_inclusive: int,
                date_col: str = "dateNotification", out: str = "annee") -> DataFrame:
    """Keep ``lo < year <= hi`` and add the year column.  Unparsable years are
    dropped.  If the year column already exists the frame is returned as is."""
    if out in df.columns:
        return df
    y = year_of(date_col)
    return df.withColumn(out, y).filter((F.col(out) > lo_exclusive) & (F.col(out) <= hi_inclusive))


def filter_not_equal(df: DataFrame, col: str, value) -> DataFrame:
    """Remove rows equal to one value (nulls are kept, like a pandas mask)."""
    return df.filter(F.col(col).isNull() | (F.col(col) != F.lit(value)))


def filter_valid_parties(df: DataFrame, buyer: str = "acheteur_id", supplier: str = "titulaire_id") -> DataFrame:
    return df.dropna(subset=[buyer, supplier])


def filter_min_group(df: DataFrame, key: str, min_rows: int = 200, not_null: Sequence[str] = ("dureeMois",)) -> DataFrame:
    """Keep groups with more than ``min_rows`` rows and drop nulls of ``not_null``.

    Group sizes come from an aggregate joined back (partial aggregation; a hot
    key never lands in one window partition)."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_gn")).filter(F.col("_gn") > min_rows)
    out = df.join(sizes.select(key), key, "left_semi")
    for c in not_null:
        out = out.filter(F.col(c).isNotNull())
    return out


def top_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent non-null keys (ties broken by key); a top-k
    report over the aggregated keys, so at most n·partitions rows merge."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(key)).limit(n))


def filter_top_categories(df: DataFrame, key: str = "codeCPV_3", top_n: int = 40) -> DataFrame:
    """Rows whose category is among the ``top_n`` most frequent.  The key
    list has at most ``top_n`` rows, so broadcasting it is bounded."""
    return df.join(F.broadcast(top_keys(df, key, top_n).select(key)), key, "left_semi")


def drop_largest(df: DataFrame, col: str, n: int = 2, tie: str = "uid") -> DataFrame:
    """Remove the ``n`` rows with the largest value (ties by ``tie``)."""
    worst = df.select(tie, col).filter(F.col(col).isNotNull()) \
              .orderBy(F.desc(col), F.asc(tie)).limit(n).select(tie)
    return df.join(F.broadcast(worst), tie, "left_anti")


def filter_isin(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str = "uid") -> DataFrame:
    """Exactly ``n`` rows, repeatable: the n smallest md5(key:seed).  A fixed
    sample size is the feature, so the top-n merge is bounded by n."""
    h = md5_key(key, seed=seed)
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def split_random(df: DataFrame, test_size: float = 0.2, seed: int = 42, key: str = "uid") -> DataFrame:
    """Adds ``split`` = test when md5 uniform < test_size, else train."""
    u = md5_uniform(key, seed=seed)
    return df.withColumn("split", F.when(u < dbl(test_size), F.lit("test")).otherwise(F.lit("train")))


def split_stratified(df: DataFrame, stratum: str, seed: int = 42, key: str = "uid",
                     test: float = 0.2, val: float = 0.16) -> DataFrame:
    """Stratified train/val/test (64/16/20 by default).

    Inside each stratum rows are ranked by md5(key:seed); the rank fraction
    decides the split.  Ranks come from the distributed order statistic on
    the hash (per-stratum thresholds), not from a window over the stratum,
    so a stratum holding a third of the rows is still split across tasks."""
    hv = df.withColumn("_hv", hash_rank_value(md5_key(key, seed=seed)))
    sizes = hv.filter(F.col(stratum).isNotNull()).groupBy(stratum).agg(F.count(F.lit(1)).alias("_cnt"))
    # rows whose 0-based rank < ceil(cnt*test) → test; next ceil(cnt*(test+val)) → val
    n_test = F.ceil(F.col("_cnt") * dbl(test))
    n_tv = F.ceil(F.col("_cnt") * dbl(test + val))
    targets = sizes.select(stratum, F.explode(F.array(
        F.struct(F.lit(0).alias("_t"), (n_test - 1).cast("double").alias("_pos")),
        F.struct(F.lit(1).alias("_t"), (n_tv - 1).cast("double").alias("_pos")))).alias("_x"), F.col("_cnt").alias("_n")) \
        .select(stratum, "_x._t", "_x._pos", "_n").filter(F.col("_pos") >= 0)
    thr = hash_statistics(hv.select(stratum, "_hv"), "_hv", targets, [stratum])
    thr = thr.groupBy(stratum).agg(
        F.max(F.when(F.col("_t") == 0, F.col("value"))).alias("_t0"),
        F.max(F.when(F.col("_t") == 1, F.col("value"))).alias("_t1"))
    thr = stage(thr, "strata")
    out = hv.join(thr, stratum, "left")
    split = (F.when(F.col("_t0").isNotNull() & (F.col("_hv") <= F.col("_t0")), F.lit("test"))
              .when(F.col("_t1").isNotNull() & (F.col("_hv") <= F.col("_t1")), F.lit("val"))
              .otherwise(F.lit("train")))
    return out.withColumn("split", split).drop("_hv", "_t0", "_t1")


def row_limit(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)
