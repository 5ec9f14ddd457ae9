"""Exact order statistics without pulling a whole group into one task.

Spark's exact ``percentile`` keeps a value→count map per group and merges it
in a single task; for a global percentile over billions of distinct amounts
that is one unbounded task.  Here the exact answer takes two passes, both
aggregated on the map side:

1. each target rank gets a bracket of values around it: from a mergeable
   ``percentile_approx`` sketch (bounded memory, skew-proof), or, for hashes,
   from their uniform law, which needs only the group's row count;
2. raw rows are tested against the brackets.  Rows below one become a single
   count per task, rows above it are dropped, and only the values inside
   reach the shuffle, where a window orders them.

The brackets are a written table of known size, so joining them moves no row.
A bracket holds about ``3/grid`` of a group's rows; where that would still be
more than ``WINDOW_ROWS``, the rows inside are bracketed once more.

Interpolation is the usual linear one (numpy ``linear``,
SQL ``percentile_cont``): ``v[r] + (v[r+1] - v[r]) * frac``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.session import stage_small as stage

DEFAULT_ACCURACY = 50_000
DEFAULT_GRID = 512
WINDOW_ROWS = 2_000_000       # values that one window may order
HASHES = float(1 << 52)       # ``hash_rank_value`` is uniform below it
DEVIATIONS = 8                # of a rank from its mean that a hash bracket covers


def _extra_probs(fixed: Sequence[float], accuracy: int) -> list[float]:
    """Sketch points next to fixed percentiles, wide enough for the sketch's
    rank error on both sides and the few rows of slack."""
    eps = 3.0 / accuracy
    return sorted({min(1.0, max(0.0, p + side)) for p in fixed for side in (-eps, eps)})


def _ranks(t: DataFrame) -> DataFrame:
    return t.withColumn("_r", F.floor("_pos")).withColumn("_s", F.ceil("_pos")).withColumn("_f", F.col("_pos") - F.col("_r"))


def _pick(v: DataFrame, t: DataFrame, g: list[str]) -> DataFrame:
    """(g..., _t, value) from rows (g..., _x) and written brackets (g..., _t,
    _lo, _hi, _r, _s, _f); a null bound is infinite.  A rank outside of its
    bracket is an error, never another value."""
    j = v.join(t, g) if g else v.crossJoin(F.broadcast(t))
    below = F.col("_lo").isNotNull() & (F.col("_x") < F.col("_lo"))
    inside = F.col("_hi").isNull() | (F.col("_x") <= F.col("_hi"))
    cells = j.filter(below | inside).select(*g, "_t", "_r", "_s", "_f", F.when(~below, F.col("_x")).alias("_x")) \
             .groupBy(*g, "_t", "_r", "_s", "_f", "_x").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*g, "_t").orderBy(F.asc_nulls_first("_x")).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("_c").over(w)
    cells = cells.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_c"))
    at = lambda r: F.max(F.when((F.col("_start") <= F.col(r)) & (F.col(r) < F.col("_end")), F.col("_x")))
    picked = cells.groupBy(*g, "_t").agg(at("_r").alias("_vr"), at("_s").alias("_vs"), F.first("_f").alias("_f"))
    missed = F.raise_error(F.lit("a rank lies outside of its bracket")).cast("double")
    value = F.when(F.col("_vr").isNull() | F.col("_vs").isNull(), missed).when(F.col("_vr") == F.col("_vs"), F.col("_vr")).otherwise(
        F.col("_vr") + (F.col("_vs") - F.col("_vr")) * F.col("_f"))
    return picked.select(*g, "_t", value.alias("value"))


def order_statistics(values: DataFrame, x: str, targets: DataFrame, group_cols: Sequence[str] = (),
                     accuracy: int = DEFAULT_ACCURACY, grid: int = DEFAULT_GRID,
                     fixed_probs: Sequence[float] = ()) -> DataFrame:
    """Values at fractional 0-based positions.

    ``values``: rows (group_cols..., x) — nulls/NaN are ignored.
    ``targets``: rows (group_cols..., _t, _p) or (group_cols..., _t, _pos):
    ``_p`` is a probability, ``_pos`` a double 0-based rank position
    (fractional → interpolation), ``_t`` a target label.  Returns
    (group_cols..., _t, value).
    """
    g = list(group_cols)
    v = values.select(*g, F.col(x).cast("double").alias("_x")).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x"))
    extra = _extra_probs(fixed_probs, accuracy)
    probs = [k / grid for k in range(grid + 1)] + extra   # one foldable literal
    eps = 1.0 / accuracy

    # one pass for the count and the sketch
    sketch = v.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_x", probs, accuracy).alias("_q")).filter("_n > 0")
    t = targets.join(sketch, g) if g else targets.crossJoin(F.broadcast(sketch))
    if "_p" in targets.columns:
        t = t.withColumn("_pos", (F.col("_n") - 1).cast("double") * F.col("_p"))

    # Bracket per target: value at the largest sketch prob <= lo_frac and at
    # the smallest sketch prob >= hi_frac.  Grid indices are arithmetic; the
    # few extra probabilities (around fixed percentiles) are tested one by one.
    # Two rows of slack on each side absorb the sketch's rank convention.
    lo_frac = (F.col("_pos") - F.lit(2.0)) / F.col("_n") - F.lit(eps)
    hi_frac = (F.col("_pos") + F.lit(3.0)) / F.col("_n") + F.lit(eps)
    lo_k = F.floor(lo_frac * F.lit(float(grid)))
    hi_k = F.ceil(hi_frac * F.lit(float(grid)))
    lo_c = [F.when(lo_k >= 0, F.element_at("_q", (lo_k + 1).cast("int")))]
    hi_c = [F.when(hi_k <= grid, F.element_at("_q", (hi_k + 1).cast("int")))]
    for k, e in enumerate(extra):
        idx = grid + 2 + k
        lo_c.append(F.when(F.lit(e) <= lo_frac, F.element_at("_q", idx)))
        hi_c.append(F.when(F.lit(e) >= hi_frac, F.element_at("_q", idx)))
    lo = F.greatest(*lo_c) if len(lo_c) > 1 else lo_c[0]      # null = -inf
    hi = F.least(*hi_c) if len(hi_c) > 1 else hi_c[0]         # null = +inf
    t = stage(_ranks(t.select(*g, "_t", "_pos", "_n", lo.alias("_lo"), hi.alias("_hi"))), "brackets")

    most = t.agg(F.max("_n")).first()[0] or 0
    if most * 3 <= WINDOW_ROWS * grid:
        return _pick(v, t.drop("_pos", "_n"), g)
    j = v.join(t, g) if g else v.crossJoin(F.broadcast(t))
    under = F.col("_lo").isNotNull() & (F.col("_x") < F.col("_lo"))
    below = j.groupBy(*g, "_t").agg(F.count_if(under).alias("_b"))
    inside = stage(j.filter(~under & (F.col("_hi").isNull() | (F.col("_x") <= F.col("_hi")))).select(*g, F.col("_t").alias("_g"), "_x"), "inside")
    closer = t.join(below, [*g, "_t"]).select(*g, F.col("_t").alias("_g"), F.lit(0).alias("_t"), (F.col("_pos") - F.col("_b")).alias("_pos"))
    return order_statistics(inside, "_x", closer, [*g, "_g"], accuracy, grid).select(*g, F.col("_g").alias("_t"), "value")


def _hash_share(pos: Column, n: Column) -> tuple[Column, Column]:
    share = (pos + 0.5) / n
    return share, DEVIATIONS * F.sqrt(share * (1 - share) / n) + 4 * DEVIATIONS / n


def hash_bound(k: Column, n: Column) -> Column:
    """A value that the ``k`` smallest of ``n`` hashes do not exceed, but for
    a chance near 1e-15; infinite if all are wanted."""
    share, width = _hash_share(k - 1, n)
    return F.when(k < n, (share + width) * HASHES).otherwise(F.lit(float("inf")))


def hash_statistics(values: DataFrame, h: str, targets: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """``order_statistics`` of uniform hashes (``hash_rank_value``) at whole
    positions: ``targets`` are rows (group_cols..., _t, _pos, _n) with the
    group's row count ``_n``.  No sketch: a rank is as many deviations from
    its mean as ``DEVIATIONS`` at most, with a chance of failure near 1e-15."""
    g = list(group_cols)
    share, width = _hash_share(F.col("_pos"), F.col("_n"))
    t = _ranks(targets.select(*g, "_t", "_pos", ((share - width) * HASHES).alias("_lo"), ((share + width) * HASHES).alias("_hi")))
    return _pick(values.select(*g, F.col(h).cast("double").alias("_x")), stage(t.drop("_pos"), "brackets"), g)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str],
                    group_cols: Sequence[str] = (), accuracy: int = DEFAULT_ACCURACY,
                    grid: int = DEFAULT_GRID) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per group, one column per
    probability (``names``).  Groups without a non-null value are absent."""
    g = list(group_cols)
    v = df.select(*g, F.col(col).alias("_v"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("_t"), F.lit(float(p)).alias("_p")) for i, p in enumerate(probs)]))
    if g:
        groups = v.filter(F.col("_v").isNotNull()).select(*g).distinct()
    else:
        groups = df.sparkSession.range(1)
    targets = groups.select(*g, wanted.alias("_tp")).select(*g, "_tp._t", "_tp._p")
    long = order_statistics(v, "_v", targets, g, accuracy, grid, fixed_probs=probs)
    return long.groupBy(*g).agg(*[
        F.max(F.when(F.col("_t") == i, F.col("value"))).alias(name) for i, name in enumerate(names)])


def exact_quantile_row(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Global quantiles as a 1-row DataFrame (always exactly one row)."""
    q = exact_quantiles(df, col, probs, names)
    one = df.sparkSession.range(1).select(F.lit(1).alias("_one"))
    return one.join(q.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")


def hash_rank_value(h: Column) -> Column:
    """Order-preserving double of an md5 hex string (first 13 hex digits =
    52 bits, exact in a double)."""
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double")


def take_smallest(df: DataFrame, h: str, n: Column, group_cols: Sequence[str] = (), hashes: bool = False) -> DataFrame:
    """Rows with the ``n`` smallest values of ``h`` per group (all rows when a
    group is smaller).  ``h`` must be (almost surely) distinct; ``hashes``
    says that it is a ``hash_rank_value``, which needs no sketch.  The cut-off
    is the distributed order statistic at rank n-1; no sort of the group and
    no single-task top-n."""
    g = list(group_cols)
    sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.first(n).alias("_want"))
    sizes = stage(sizes, "sizes")
    targets = sizes.filter("_want > 0 AND _want < _n").select(*g, F.lit(0).alias("_t"), (F.col("_want") - 1).cast("double").alias("_pos"), "_n")
    if hashes:
        cut = hash_statistics(df.select(*g, h), h, targets, g)
    else:
        cut = order_statistics(df.select(*g, h), h, targets.drop("_n"), g)
    cut = cut.select(*g, F.col("value").alias("_cut"))
    whole = sizes.filter("_want >= _n").select(*g, F.lit(float("inf")).alias("_cut"))
    cut = stage(cut.unionByName(whole), "cuts")
    j = df.join(cut, g) if g else df.crossJoin(F.broadcast(cut))
    return j.filter(F.col(h) <= F.col("_cut")).drop("_cut")


def k_smallest_per_group(df: DataFrame, h: str, k: int, group_cols: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the smallest ``h`` of each group, for a fixed
    ``k``.  Spark limits each task to k rows of a group before the shuffle
    (``WindowGroupLimit``), so a hot group costs k rows per task."""
    w = Window.partitionBy(*group_cols).orderBy(h)
    return df.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= k).drop("_place")
