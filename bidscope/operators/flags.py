"""Red-flag rules.

Each rule is expressed once as a set-based plan.  Group rules aggregate first
(partial aggregation on the map side, so a key holding a third of the rows
costs one pre-aggregated row per map task) and only the small key/statistic
tables are joined back.  Temporal rules run their range windows over
per-day counts, so a window partition holds at most one row per distinct
day of a group, never the group's rows.

Exchanges for the full set of ten flags: category, (buyer, cpv[, supplier]),
(buyer, supplier), (buyer, supplier, cpv, day), plus two global percentiles
computed by the distributed order statistic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.columns import dbl, parse_date, pct, prevalence_status
from bidscope.sources.tables import COMPETITIVE_PROCEDURES, NON_COMPETITIVE_PROCEDURES
from bidscope.session import stage_small as stage

# Rule names in the reference's order.
RULES = [
    "single_bid_competitive",
    "price_inflation",
    "price_deflation",
    "procedure_manipulation",
    "suspicious_modifications",
    "high_market_concentration",
    "temporal_clustering",
    "excessive_subcontracting",
    "short_contract_duration",
    "suspicious_buyer_supplier_pairs",
]
# Rules that also exist as row removers, default removal list.
REMOVABLE = [
    "single_bid_competitive",
    "price_inflation",
    "price_deflation",
    "high_market_concentration",
    "temporal_clustering",
    "suspicious_buyer_supplier_pairs",
]


@dataclass(frozen=True)
class RuleParams:
    buyer: str = "acheteur_id"
    supplier: str = "titulaire_id"
    category: str = "codeCPV_3"
    temporal_buyer: str | None = None       # buyer key for temporal rules (default: buyer)
    amount: str = "montant"
    duration: str = "dureeMois"
    date: str = "dateNotification"
    min_group: int = 200
    inflation_k: float = 3.0
    deflation_k: float = 3.0
    share: float = 0.7
    min_total: int = 2
    pair_k: float = 2.0
    burst_days: int = 30
    burst_k: int = 4
    proc_pct: float = 0.75
    duration_pct: float = 0.95

    @property
    def tbuyer(self) -> str:
        return self.temporal_buyer or self.buyer


# ------------------------------------------------------------ row-local rules
def single_bid(p: RuleParams = RuleParams()) -> Column:
    return F.col("procedure").isin(*COMPETITIVE_PROCEDURES) & (F.col("offresRecues") == dbl(1))


def subcontracting() -> Column:
    return F.col("sousTraitanceDeclaree") == dbl(1)


def short_duration(p: RuleParams = RuleParams()) -> Column:
    d = F.col(p.duration)
    return (d > dbl(0)) & (d < dbl(1))


# ------------------------------------------------------------ category stats
def category_stats(df: DataFrame, p: RuleParams) -> DataFrame:
    """mean, sample std and count per category over rows with an amount;
    only categories with ≥ min_group rows and a positive std."""
    a, c = F.col(p.amount), F.col(p.category)
    return (df.filter(a.isNotNull() & c.isNotNull())
              .groupBy(p.category)
              .agg(F.count(F.lit(1)).alias("_cat_n"), F.avg(a).alias("_cat_mean"),
                   F.stddev_samp(a).alias("_cat_std"))
              .filter((F.col("_cat_n") >= p.min_group) & (F.col("_cat_std") > dbl(0))))


def with_price_flags(df: DataFrame, p: RuleParams) -> DataFrame:
    """Adds ``price_inflation`` and ``price_deflation`` booleans.  The stats
    table has one row per category and is written first: the planner then
    knows its size and need not shuffle the rows by a hot category."""
    st = stage(category_stats(df, p), "category-stats")
    a = F.col(p.amount)
    infl_thr = F.col("_cat_mean") + dbl(p.inflation_k) * F.col("_cat_std")
    defl_thr = F.greatest(F.col("_cat_mean") - dbl(p.deflation_k) * F.col("_cat_std"), dbl(0))
    out = df.join(st, p.category, "left")
    return out.withColumns({
        "price_inflation": F.coalesce(a > infl_thr, F.lit(False)),
        "price_deflation": F.coalesce((a > dbl(0)) & (a < defl_thr), F.lit(False)),
    }).drop("_cat_n", "_cat_mean", "_cat_std")


# ------------------------------------------------------------ global percentiles
def global_thresholds(df: DataFrame, p: RuleParams) -> DataFrame:
    """One row: p75 of amount, p95 of duration (exact, distributed), both
    from one grouped order-statistics pass over the stacked columns."""
    from bidscope.operators.quantiles import exact_quantiles
    long = df.select(F.explode(F.array(
        F.struct(F.lit("a").alias("_which"), F.col(p.amount).cast("double").alias("_v")),
        F.struct(F.lit("d").alias("_which"), F.col(p.duration).cast("double").alias("_v")))).alias("_s")) \
        .select("_s._which", "_s._v")
    q = exact_quantiles(long, "_v", [p.proc_pct, p.duration_pct], ["_qa", "_qd"], ["_which"])
    return q.agg(F.max(F.when(F.col("_which") == "a", F.col("_qa"))).alias("_amount_p"),
                 F.max(F.when(F.col("_which") == "d", F.col("_qd"))).alias("_duration_p"))   # always one row


def with_percentile_flags(df: DataFrame, p: RuleParams) -> DataFrame:
    thr = global_thresholds(df, p)
    out = df.crossJoin(F.broadcast(thr))  # exactly one row
    return out.withColumns({
        "procedure_manipulation": F.coalesce(
            (F.col(p.amount) > F.col("_amount_p")) & F.col("procedure").isin(*NON_COMPETITIVE_PROCEDURES),
            F.lit(False)),
        "suspicious_modifications": F.coalesce(F.col(p.duration) > F.col("_duration_p"), F.lit(False)),
    }).drop("_amount_p", "_duration_p")


# ------------------------------------------------------------ concentration
def concentration_keys(df: DataFrame, p: RuleParams) -> DataFrame:
    """(buyer, cpv, supplier) whose share of the (buyer, cpv) rows is above
    ``share`` while the (buyer, cpv) group has more than ``min_total`` rows.
    The total counts rows with a null supplier too; ``_n`` = rows of the key."""
    b, c, s = p.buyer, p.category, p.supplier
    bc = df.filter(F.col(b).isNotNull() & F.col(c).isNotNull())
    triple = bc.filter(F.col(s).isNotNull()).groupBy(b, c, s).agg(F.count(F.lit(1)).alias("_n"))
    total = bc.groupBy(b, c).agg(F.count(F.lit(1)).alias("_tot"))
    j = triple.join(total, [b, c])
    return j.filter((F.col("_n") / F.col("_tot") > dbl(p.share)) & (F.col("_tot") > p.min_total)) \
            .select(b, c, s, "_n")


# ------------------------------------------------------------ heavy pairs
def pair_totals(df: DataFrame, p: RuleParams) -> DataFrame:
    """Per (buyer, supplier): sum of amounts (all-null → 0, like pandas),
    number of non-null amounts, number of rows."""
    b, s = p.buyer, p.supplier
    return (df.filter(F.col(b).isNotNull() & F.col(s).isNotNull()).groupBy(b, s)
              .agg(F.coalesce(F.sum(p.amount), F.lit(0).cast(df.schema[p.amount].dataType)).alias("_sum"),
                   F.count(p.amount).alias("_cnt"),
                   F.count(F.lit(1)).alias("_n")))


def heavy_pair_keys(df: DataFrame, p: RuleParams, k: float | None = None) -> DataFrame:
    k = p.pair_k if k is None else k
    pt = pair_totals(df, p)
    st = pt.agg(F.avg("_sum").alias("_pm"), F.stddev_samp("_sum").alias("_ps"))  # one row
    j = pt.crossJoin(F.broadcast(st))
    return j.filter((F.col("_ps") > dbl(0)) & (F.col("_sum") > F.col("_pm") + dbl(k) * F.col("_ps"))
                    & (F.col("_cnt") >= 2)).select(p.buyer, p.supplier, "_n", "_sum", "_cnt")


# ------------------------------------------------------------ temporal bursts
def day_counts(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Rows per (keys, day) with valid keys and a parseable date."""
    day = F.unix_date(parse_date(date_col))
    cond = day.isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond).groupBy(*keys, day.alias("_day")).agg(F.count(F.lit(1)).alias("_dn"))


def burst_days(df: DataFrame, keys: Sequence[str], date_col: str, days: int, k: int) -> DataFrame:
    """(keys, _day, _start, _member): a day starts a burst when the window
    [day, day+days] holds ≥ k rows; a day is a member when some start day
    lies in [day-days, day]."""
    dc = day_counts(df, keys, date_col)
    w = Window.partitionBy(*keys).orderBy("_day")
    dc = dc.withColumn("_fwd", F.sum("_dn").over(w.rangeBetween(0, days)))
    dc = dc.withColumn("_start", (F.col("_fwd") >= k).cast("int"))
    return dc.withColumn("_member", F.max("_start").over(w.rangeBetween(-days, 0)))


def burst_groups(df: DataFrame, keys: Sequence[str], date_col: str, days: int = 30, k: int = 4) -> DataFrame:
    """Groups holding k rows whose dates span at most ``days`` days, i.e.
    ``d[i+k-1] - d[i] <= days`` for some i in date order."""
    bd = burst_days(df, keys, date_col, days, k)
    return bd.groupBy(*keys).agg(F.max("_start").alias("_hit")).filter(F.col("_hit") == 1).select(*keys)


def burst_members(df: DataFrame, keys: Sequence[str], date_col: str, days: int, k: int) -> DataFrame:
    """Rows of ``df`` lying in any window [d_i, d_i+days] that holds ≥ k rows."""
    bd = burst_days(df, keys, date_col, days, k).filter(F.col("_member") == 1).select(*keys, "_day")
    rows = df.withColumn("_day", F.unix_date(parse_date(date_col)))
    return rows.join(bd, [*keys, "_day"], "left_semi").drop("_day")


def temporal_keys(p: RuleParams) -> list[str]:
    return [p.tbuyer, p.supplier, p.category]


# ------------------------------------------------------------ report
def anomaly_report(df: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """All ten rules: count, % of rows, prevalence status, sorted by % desc.

    Row-local and category rules are summed in one pass over the rows; the
    concentration and pair rules are summed from their key tables (row
    counts per key), so no row-level join is needed for them."""
    rows = with_percentile_flags(with_price_flags(df, p), p)
    local = rows.agg(
        F.count(F.lit(1)).alias("_total"),
        F.count_if(single_bid(p)).alias("single_bid_competitive"),
        F.count_if("price_inflation").alias("price_inflation"),
        F.count_if("price_deflation").alias("price_deflation"),
        F.count_if("procedure_manipulation").alias("procedure_manipulation"),
        F.count_if("suspicious_modifications").alias("suspicious_modifications"),
        F.count_if(F.coalesce(subcontracting(), F.lit(False))).alias("excessive_subcontracting"),
        F.count_if(F.coalesce(short_duration(p), F.lit(False))).alias("short_contract_duration"))
    conc = concentration_keys(df, p).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("high_market_concentration"))
    pairs = heavy_pair_keys(df, p).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("suspicious_buyer_supplier_pairs"))
    temporal = burst_groups(df, temporal_keys(p), p.date, p.burst_days, p.burst_k) \
        .agg((F.count(F.lit(1)) * F.lit(p.burst_k)).alias("temporal_clustering"))
    one = local.crossJoin(conc).crossJoin(pairs).crossJoin(temporal)  # four 1-row frames
    long = one.select("_total", F.explode(F.array(*[
        F.struct(F.lit(r).alias("anomaly_type"), F.col(r).cast("bigint").alias("n_flagged"))
        for r in RULES])).alias("_r")).select("_total", "_r.*")
    perc = pct("n_flagged", "_total")
    return long.select(
        "anomaly_type", "n_flagged", F.round(perc, 6).alias("percentage"),
        prevalence_status(perc).alias("status"), F.col("_total").cast("bigint").alias("total_contracts")) \
        .orderBy(F.desc("percentage"), "anomaly_type")   # ten rows


# ------------------------------------------------------------ row flags / removal
def flag_rows(df: DataFrame, p: RuleParams = RuleParams(), rules: Sequence[str] = REMOVABLE,
              strict: bool = True) -> DataFrame:
    """``df`` plus one boolean column per requested rule (remover semantics:
    temporal = burst members (15 d, ≥5) strict or (30 d, ≥3); pairs mean + 2σ
    strict or 1.5σ) and ``any_flag``."""
    out = df
    need_price = {"price_inflation", "price_deflation"} & set(rules)
    if need_price:
        out = with_price_flags(out, p)
    if {"procedure_manipulation", "suspicious_modifications"} & set(rules):
        out = with_percentile_flags(out, p)
    cols: dict[str, Column] = {}
    if "single_bid_competitive" in rules:
        cols["single_bid_competitive"] = F.coalesce(single_bid(p), F.lit(False))
    if "excessive_subcontracting" in rules:
        cols["excessive_subcontracting"] = F.coalesce(subcontracting(), F.lit(False))
    if "short_contract_duration" in rules:
        cols["short_contract_duration"] = F.coalesce(short_duration(p), F.lit(False))
    if cols:
        out = out.withColumns(cols)
    if "high_market_concentration" in rules:
        keys = concentration_keys(df, p).select(p.buyer, p.category, p.supplier) \
            .withColumn("high_market_concentration", F.lit(True))
        out = out.join(keys, [p.buyer, p.category, p.supplier], "left").fillna(
            False, subset=["high_market_concentration"])
    if "suspicious_buyer_supplier_pairs" in rules:
        keys = heavy_pair_keys(df, p, 2.0 if strict else 1.5).select(p.buyer, p.supplier) \
            .withColumn("suspicious_buyer_supplier_pairs", F.lit(True))
        out = out.join(keys, [p.buyer, p.supplier], "left").fillna(
            False, subset=["suspicious_buyer_supplier_pairs"])
    if "temporal_clustering" in rules:
        days, k = (15, 5) if strict else (30, 3)
        tk = temporal_keys(p)
        member_days = burst_days(df, tk, p.date, days, k).filter(F.col("_member") == 1) \
            .select(*tk, "_day").withColumn("temporal_clustering", F.lit(True))
        out = out.withColumn("_day", F.unix_date(parse_date(p.date))) \
                 .join(member_days, [*tk, "_day"], "left").drop("_day") \
                 .fillna(False, subset=["temporal_clustering"])
    anyf = F.lit(False)
    for r in rules:
        anyf = anyf | F.col(r)
    return out.withColumn("any_flag", anyf)


def identify_anomalies(df: DataFrame, p: RuleParams = RuleParams(), rules: Sequence[str] = REMOVABLE,
                       strict: bool = True, key: str = "uid") -> DataFrame:
    """Distinct keys flagged by any requested rule, with one flag per rule."""
    fr = flag_rows(df, p, rules, strict)
    return fr.filter("any_flag").select(key, *[F.col(r) for r in rules])


def clean_dataset(df: DataFrame, p: RuleParams = RuleParams(), rules: Sequence[str] = REMOVABLE,
                  strict: bool = True) -> DataFrame:
    """Rows not flagged by any requested rule (original columns only)."""
    fr = flag_rows(df, p, rules, strict)
    return fr.filter(~F.col("any_flag")).select(*df.columns)


def same_pair_limit(df: DataFrame, p: RuleParams = RuleParams(), limit: int = 10) -> DataFrame:
    """Declared rule: more than ``limit`` contracts between the same parties."""
    b, s = p.buyer, p.supplier
    pairs = df.groupBy(b, s).agg(F.count(F.lit(1)).alias("n_contracts")).filter(F.col("n_contracts") > limit)
    return df.join(pairs, [b, s])


def amount_variation(df: DataFrame, p: RuleParams = RuleParams(), threshold: float = 0.5) -> DataFrame:
    """Declared rule (formula is ours): |amount − category median| / median
    above ``threshold``.  Medians come from the exact distributed quantile."""
    from bidscope.operators.quantiles import exact_quantiles
    med = exact_quantiles(df, p.amount, [0.5], ["category_median"], [p.category])
    j = df.join(med, p.category)
    dev = F.abs(F.col(p.amount) - F.col("category_median")) / F.col("category_median")
    return j.withColumn("variation", dev).filter(
        (F.col("category_median") != dbl(0)) & (F.col("variation") > dbl(threshold)))


def params_for_tests(**kw) -> RuleParams:
    """Parameters of the registered plans on the test tables."""
    base = RuleParams(category="categorie", temporal_buyer="acheteur_region", deflation_k=1.0)
    return replace(base, **kw)
