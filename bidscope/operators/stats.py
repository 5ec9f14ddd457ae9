"""Aggregations, windows, top-k and set operations.

Rule of thumb used throughout: group first (partial aggregation), then
join or window over the aggregated table.  Windows without a partition key
appear only over tables whose size is bounded by construction (bins,
categories, components), and each such use says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.columns import dbl
from bidscope.operators.quantiles import exact_quantiles


# ----------------------------------------------------------------- counts
def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Share of each non-null value; the total is a 1-row aggregate."""
    vc = value_counts(df, col)
    tot = vc.agg(F.sum("n").alias("_tot"))
    return vc.crossJoin(F.broadcast(tot)).select(col, (F.col("n") / F.col("_tot")).alias("share"))


def share_compare(df: DataFrame, col: str, flag: Column) -> DataFrame:
    """Category shares among flagged and among normal rows, joined on the
    category (full join: a category may appear on one side only)."""
    tagged = df.withColumn("_flag", flag)
    a = value_shares(tagged.filter("_flag"), col).withColumnRenamed("share", "share_flagged")
    b = value_shares(tagged.filter(~F.col("_flag")), col).withColumnRenamed("share", "share_normal")
    return a.join(b, col, "full").fillna(0.0, subset=["share_flagged", "share_normal"])


def group_size(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def group_mean_std_count(df: DataFrame, group: str, value: str, min_count: int = 200) -> DataFrame:
    return (df.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group)
              .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= min_count))


def group_medians(df: DataFrame, group: str, value: str) -> DataFrame:
    return exact_quantiles(df, value, [0.5], ["median"], [group])


def distinct_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-null values per column, one row."""
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def percentiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    names = [f"p{str(p).replace('.', '_')}" for p in probs]
    return exact_quantiles(df, col, probs, names)


def mode_share(df: DataFrame, group: str, cat: str) -> DataFrame:
    """Per group: most frequent category (ties → smallest), its share, and
    the number of distinct categories.  Counts per (group, category) are
    aggregated first, so the window sees one row per category of a group."""
    gc = df.filter(F.col(group).isNotNull() & F.col(cat).isNotNull()) \
           .groupBy(group, cat).agg(F.count(F.lit(1)).alias("_n"))
    agg = gc.groupBy(group).agg(F.sum("_n").alias("_tot"), F.count(F.lit(1)).alias("diversity"))
    w = Window.partitionBy(group).orderBy(F.desc("_n"), F.asc(cat))
    top = gc.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1") \
            .select(group, F.col(cat).alias("top_value"), F.col("_n").alias("_top_n"))
    return agg.join(top, group) \
              .select(group, "top_value", (F.col("_top_n") / F.col("_tot")).alias("top_share"), "diversity")


def crosstab_normalized(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long form of ``crosstab(row, col, normalize='index')``."""
    c = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col) \
          .agg(F.count(F.lit(1)).alias("_n"))
    tot = c.groupBy(row).agg(F.sum("_n").alias("_tot"))
    return c.join(tot, row).select(row, col, (F.col("_n") / F.col("_tot")).alias("share"))


def describe_table(df: DataFrame, col: str) -> DataFrame:
    """count/mean/std/min/25%/50%/75%/max of one numeric column (one row)."""
    base = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                  F.min(col).alias("min"), F.max(col).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return base.crossJoin(q)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, one pass, unpivoted to (column, n_null)."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "n_null")


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (a < b), one aggregation pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("col_a"),
                       F.split_part("pair", F.lit("|"), F.lit(2)).alias("col_b"), "corr")


def corr_target(df: DataFrame, cols: Sequence[str], target: str, k: int = 10) -> DataFrame:
    """|corr(feature, target)| ranked, top ``k`` (report over ≤ len(cols) rows)."""
    one = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    long = one.unpivot([], list(cols), "feature", "corr").withColumn("abs_corr", F.abs("corr"))
    return long.filter(F.col("abs_corr").isNotNull()).orderBy(F.desc("abs_corr"), "feature").limit(k)


def histogram_log(df: DataFrame, col: str, lo_exp: float = 0.0, hi_exp: float = 10.0, bins: int = 50) -> DataFrame:
    """Counts per log10-spaced bin; bin 0 below the range, bins+1 above."""
    x = F.col(col)
    b = F.width_bucket(F.log10(x), dbl(lo_exp), dbl(hi_exp), F.lit(bins))
    return df.filter(x > 0).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def threshold_tail_counts(df: DataFrame, col: str, above: Sequence[float], below: Sequence[float]) -> DataFrame:
    """Rows above / below each amount, all in one pass."""
    x = F.col(col)
    aggs = [F.count_if(x > dbl(t)).alias(f"above_{int(t)}") for t in above]
    aggs += [F.count_if(x < dbl(t)).alias(f"below_{int(t)}") for t in below]
    return df.agg(*aggs)


def cluster_profile(df: DataFrame, cluster: str, cpv: str, amount: str, duration: str,
                    min_size: int = 20) -> DataFrame:
    """Per cluster (size ≥ min_size): size, % of rows, top code and its %,
    code diversity, amount mean/median/std, duration mean/median,
    euro_per_month = median amount / median duration (amount if ≤ 0)."""
    base = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), F.avg(amount).alias("mean_amount"),
        F.stddev_samp(amount).alias("std_amount"), F.avg(duration).alias("mean_duration"))
    tot = df.agg(F.count(F.lit(1)).alias("_tot"))
    med_a = exact_quantiles(df, amount, [0.5], ["median_amount"], [cluster])
    med_d = exact_quantiles(df, duration, [0.5], ["median_duration"], [cluster])
    ms = mode_share(df, cluster, cpv).select(
        cluster, F.col("top_value").alias("top_cpv"), (F.col("top_share") * dbl(100)).alias("top_cpv_pct"),
        F.col("diversity").alias("cpv_diversity"))
    out = (base.filter(F.col("size") >= min_size).crossJoin(F.broadcast(tot))
               .join(med_a, cluster, "left").join(med_d, cluster, "left").join(ms, cluster, "left"))
    epm = F.when(F.col("median_duration") > 0, F.col("median_amount") / F.col("median_duration")) \
           .otherwise(F.col("median_amount"))
    return out.withColumn("pct_total", F.col("size") * dbl(100) / F.col("_tot")) \
              .withColumn("euro_per_month", epm).drop("_tot")


# ----------------------------------------------------------------- windows
def partition_share(df: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """Share of ``member`` inside each group: counts per (group, member)
    divided by the group total — computed on the aggregated table."""
    g = list(group)
    c = df.groupBy(*g, member).agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy(*g).agg(F.sum("n").alias("group_total"))
    return c.join(tot, g).withColumn("share", F.col("n") / F.col("group_total"))


def topk_per_group(df: DataFrame, group: str, cat: str, k: int = 3) -> DataFrame:
    """k most common categories per group with their share (ties by value).
    The window runs over per-(group, category) counts."""
    c = df.filter(F.col(cat).isNotNull()).groupBy(group, cat).agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy(group).agg(F.sum("n").alias("_tot"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), F.asc(cat))
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).join(tot, group) \
            .withColumn("share", F.col("n") / F.col("_tot")).drop("_tot")


def rolling_mean(df: DataFrame, order: str, value: str, before: int = 5, after: int = 4) -> DataFrame:
    """Centred rolling mean (``rolling(10, center=True, min_periods=1)``).
    Meant for bounded series (bins, components): unpartitioned window."""
    w = Window.orderBy(order).rowsBetween(-before, after)
    return df.withColumn("rolling_mean", F.avg(value).over(w))


def cumulative_sum(df: DataFrame, order: Column | str, value: str, out: str = "cumsum") -> DataFrame:
    """Running total over a bounded, ordered series (unpartitioned window)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def dense_ids(keys: DataFrame, key: str, out: str = "id", offset: Column | int = 0,
              partitions: int | None = None) -> DataFrame:
    """0-based id per distinct key in key order, without a single-task window.

    Distinct keys are range-partitioned; each range partition numbers its
    rows locally, and partition offsets (one row per partition) are summed.
    """
    spark = keys.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    from bidscope.session import cut_lineage
    # partition ids are read by two branches below: pin them by writing once
    d = cut_lineage(keys.select(key).filter(F.col(key).isNotNull()).distinct()
                    .repartitionByRange(n_parts, key).withColumn("_pid", F.spark_partition_id()))
    local = d.withColumn("_loc", F.row_number().over(Window.partitionBy("_pid").orderBy(key)) - 1)
    sizes = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_sz"))
    # one row per partition: bounded by the partition count
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_sz").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    off = offset if isinstance(offset, Column) else F.lit(offset)
    return local.join(F.broadcast(offs.select("_pid", "_off")), "_pid") \
                .select(key, (F.col("_loc") + F.col("_off") + off).cast("bigint").alias(out))


# ----------------------------------------------------------------- set ops
def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    return df.unionByName(extra, allowMissingColumns=True)


def rows_except(df: DataFrame, keys: DataFrame, key: str = "uid") -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def replace_rows(df: DataFrame, new: DataFrame, key: str = "uid") -> DataFrame:
    """Overwrite rows by key with ``new`` (shared columns only), keep the
    rest.  Rows of ``new`` whose key is not in the table are left out."""
    shared = [c for c in df.columns if c in new.columns]
    known = new.join(df.select(key).distinct(), key, "left_semi")
    return df.join(new.select(key), key, "left_anti").select(*shared).unionByName(known.select(*shared))


def ordered_prefix_sums(df: DataFrame, order: str, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Exact running totals of ``cols`` over a global order, strictly before
    each row (``<col>_before``), without a single-task window: rows are
    range-partitioned on ``order``, each partition sums locally, and the
    per-partition totals (one row per partition) give the offsets.
    ``order`` must be unique (aggregate duplicates first)."""
    from bidscope.session import cut_lineage
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(df.repartitionByRange(n_parts, order).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = d.withColumns({f"_l_{c}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in cols})
    tot = d.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    offs = tot.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}") for c in cols])
    out = local.join(F.broadcast(offs), "_pid")
    return out.select(*df.columns, *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"{c}_before") for c in cols])
