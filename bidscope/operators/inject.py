"""Synthetic anomaly injection.

Every random choice is an md5 draw keyed by (row or group key, type, seed),
so a run is repeatable and the same choices can be written in SQL.  Per type
the ``n`` eligible rows (or groups) with the smallest hash are taken with the
distributed order statistic (``take_smallest``): no global sort, no
single-task top-n, exact counts.

Output of ``candidates``: one row per (template uid, type, slot) with the new
values of the columns the type changes (null = unchanged).  ``inject_replace``
keeps, per uid, the type that comes last in the list (later wins) and its
last slot; ``inject_append`` appends every candidate as a new row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.columns import dbl, md5_key, md5_uniform, parse_date
from bidscope.operators.flags import RULES
from bidscope.operators.quantiles import HASHES, hash_bound, hash_rank_value, k_smallest_per_group, take_smallest
from bidscope.session import stage_small as stage
from bidscope.sources.tables import COMPETITIVE_PROCEDURES, NON_COMPETITIVE_PROCEDURES

TYPES = list(RULES)                      # fixed code table: 1-based position
TYPE_CODE = {t: i + 1 for i, t in enumerate(TYPES)}
NEW_COLS = {                              # changed column → its type
    "montant": "double", "offresRecues": "double", "procedure": "string", "dureeMois": "double",
    "sousTraitanceDeclaree": "double", "titulaire_id": "string", "dateNotification": "string",
}


@dataclass(frozen=True)
class InjectParams:
    pct: float = 0.05
    seed: int = 42
    buyer: str = "acheteur_id"
    supplier: str = "titulaire_id"
    category: str = "codeCPV_3"
    amount: str = "montant"
    duration: str = "dureeMois"
    date: str = "dateNotification"
    key: str = "uid"


def per_type_count(df: DataFrame, n_types: int, p: InjectParams) -> DataFrame:
    """One row: ``_n`` = max(1, int(rows·pct) // n_types)."""
    total = F.floor(F.count(F.lit(1)).cast("double") * dbl(p.pct))
    return df.agg(F.greatest(F.lit(1), (total / n_types).cast("bigint")).alias("_n"))


def _h(*parts, p: InjectParams, salt: str) -> Column:
    return hash_rank_value(md5_key(*parts, F.lit(salt), seed=p.seed))


def _u(*parts, p: InjectParams, salt: str) -> Column:
    return md5_uniform(*parts, F.lit(salt), seed=p.seed)


def _shape(df: DataFrame, t: str, p: InjectParams, slot: Column | None = None, **new: Column) -> DataFrame:
    cols = [F.col(p.key), F.lit(t).alias("anomaly_type"), F.lit(TYPE_CODE[t]).alias("type_code"),
            (slot if slot is not None else F.lit(0)).alias("slot")]
    for c, typ in NEW_COLS.items():
        cols.append((new[c] if c in new else F.lit(None)).cast(typ).alias(f"new_{c}"))
    return df.select(*cols)


def _cat_stats(df: DataFrame, p: InjectParams) -> DataFrame:
    a, c = F.col(p.amount), F.col(p.category)
    return (df.filter(a.isNotNull() & c.isNotNull() & (a > 0)).groupBy(p.category)
              .agg(F.count(F.lit(1)).alias("_cn"), F.avg(a).alias("_cm"), F.stddev_samp(a).alias("_cs"))
              .filter((F.col("_cn") >= 200) & (F.col("_cs") > 0)))


# ---------------------------------------------------------------- row types
# A row type is a condition and new values.  Two passes serve all requested
# types: one counts the eligible rows of each, which bounds the hash of the
# rows it can take; the next keeps only (row, type) pairs below their bound.
# What is left, little more than the rows taken, is cut exactly.
def _conditions(p: InjectParams) -> dict[str, Column]:
    """Per type whether a row is eligible; ``_cm`` and ``_cs`` are its category's."""
    a, d = F.col(p.amount), F.col(p.duration)
    competitive = F.col("procedure").isin(*COMPETITIVE_PROCEDURES)
    conditions = {
        "single_bid_competitive": competitive & (F.col("offresRecues") > 1),
        "price_inflation": (a > 0) & (a < _threshold("price_inflation")),
        "price_deflation": (a > 0) & (a > _threshold("price_deflation")),
        "procedure_manipulation": competitive,
        "suspicious_modifications": (d > 0) & (d < 36),
        "excessive_subcontracting": F.col("sousTraitanceDeclaree") == 0,
        "short_contract_duration": d > 1,
    }
    return {t: F.coalesce(c, F.lit(False)) for t, c in conditions.items()}


def _threshold(t: str) -> Column:
    if t == "price_inflation":
        return F.col("_cm") + dbl(3) * F.col("_cs")
    if t == "price_deflation":          # no value (not 0) without statistics
        return F.when(F.col("_cm").isNotNull(), F.greatest(F.col("_cm") - dbl(3) * F.col("_cs"), dbl(0)))
    return F.lit(None).cast("double")


ROW_TYPES = ["single_bid_competitive", "price_inflation", "price_deflation", "procedure_manipulation",
             "suspicious_modifications", "excessive_subcontracting", "short_contract_duration"]


def _row_new_values(p: InjectParams) -> dict[str, Column]:
    t = F.col("anomaly_type")
    a, d = F.col(p.amount), F.col(p.duration)

    def u(name, suffix):
        return _u(p.key, p=p, salt=name + suffix)
    infl = F.col("_thr") * (dbl(1.1) + u("price_inflation", ":m") * dbl(0.4))
    ud = u("price_deflation", ":m")
    defl = F.when(F.col("_thr") > 0, F.col("_thr") * (dbl(0.5) + ud * dbl(0.4))) \
            .otherwise(F.col("_cm") * (dbl(0.01) + ud * dbl(0.04)))
    proc = F.when(u("procedure_manipulation", ":p") < dbl(0.5), F.lit(NON_COMPETITIVE_PROCEDURES[0])) \
            .otherwise(F.lit(NON_COMPETITIVE_PROCEDURES[1]))
    long_d = d * (dbl(2.5) + u("suspicious_modifications", ":d") * dbl(2.5))
    short_d = dbl(0.1) + u("short_contract_duration", ":d") * dbl(0.8)
    return {
        "montant": F.when(t == "price_inflation", infl).when(t == "price_deflation", defl),
        "offresRecues": F.when(t == "single_bid_competitive", dbl(1)),
        "procedure": F.when(t == "procedure_manipulation", proc),
        "dureeMois": F.when(t == "suspicious_modifications", long_d).when(t == "short_contract_duration", short_d),
        "sousTraitanceDeclaree": F.when(t == "excessive_subcontracting", dbl(1)),
    }


def row_candidates(df: DataFrame, n: DataFrame, p: InjectParams, types: Sequence[str]) -> DataFrame:
    if {"price_inflation", "price_deflation"} & set(types):
        d = df.join(_cat_stats(df, p), p.category, "left")
    else:
        d = df.withColumns({"_cm": F.lit(None).cast("double"), "_cs": F.lit(None).cast("double")})
    eligible = _conditions(p)
    sizes = d.agg(*[F.count_if(eligible[t]).alias(f"_size_{t}") for t in types]).crossJoin(F.broadcast(n))
    bounds = stage(sizes.select("_n", *[c for t in types for c in (
        F.col(f"_size_{t}"), hash_bound(F.col("_n"), F.col(f"_size_{t}")).alias(f"_bound_{t}"))]), "bounds")
    pairs = []
    for t in types:
        h = _h(p.key, p=p, salt=t)
        pairs.append(F.when(eligible[t] & (h <= F.col(f"_bound_{t}")), F.struct(
            F.lit(t).alias("anomaly_type"), (h * (HASHES / F.least(F.col(f"_bound_{t}"), F.lit(HASHES)))).alias("_h"),
            _threshold(t).alias("_thr"),
            F.least("_n", f"_size_{t}").alias("_want"))))
    near = d.crossJoin(F.broadcast(bounds)).select(          # bounds: one row
        p.key, p.amount, p.duration, "_cm", F.explode(F.array_compact(F.array(*pairs))).alias("_p"))
    near = stage(near.select(p.key, p.amount, p.duration, "_cm", "_p.*"), "near")
    short = near.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("_near"), F.first("_want").alias("_want"))
    if short.filter("_near < _want").first():
        raise RuntimeError("fewer rows below a hash bound than are to be taken")
    # stretched by its bound, a hash is uniform again
    sel = take_smallest(near, "_h", F.col("_want"), ["anomaly_type"], hashes=True)
    codes = F.create_map(*[x for t in types for x in (F.lit(t), F.lit(TYPE_CODE[t]))])
    newv = _row_new_values(p)
    cols = [F.col(p.key), F.col("anomaly_type"), codes[F.col("anomaly_type")].alias("type_code"),
            F.lit(0).alias("slot")]
    for c, typ in NEW_COLS.items():
        cols.append((newv[c] if c in newv else F.lit(None)).cast(typ).alias(f"new_{c}"))
    return sel.select(*cols)


def _row_generator(t: str):
    def gen(df, n, p):
        return row_candidates(df, n, p, [t])
    gen.__name__ = t
    return gen


single_bid = _row_generator("single_bid_competitive")
price_inflation = _row_generator("price_inflation")
price_deflation = _row_generator("price_deflation")
procedure_manipulation = _row_generator("procedure_manipulation")
suspicious_modifications = _row_generator("suspicious_modifications")
excessive_subcontracting = _row_generator("excessive_subcontracting")
short_contract_duration = _row_generator("short_contract_duration")


# ---------------------------------------------------------------- group types
def _take_groups(groups: DataFrame, keys: Sequence[str], t: str, n_groups: Column, p: InjectParams) -> DataFrame:
    # the eligible groups are read three times, the taken ones by every step that follows
    g = stage(groups.withColumn("_gh", _h(*keys, p=p, salt=t + ":g")).withColumn("_gn", n_groups), "groups")
    return stage(take_smallest(g, "_gh", F.col("_gn"), hashes=True).drop("_gh", "_gn"), "taken-groups")


def _take_in_group(rows: DataFrame, keys: Sequence[str], t: str, k: int, p: InjectParams) -> DataFrame:
    """≤ k rows per group (smallest hashes) plus their 0-based rank; the
    rank window only ever sees ≤ k rows per group."""
    from pyspark.sql import Window
    r = rows.withColumn("_rh", _h(p.key, p=p, salt=t + ":r"))
    top = k_smallest_per_group(r, "_rh", k, keys)
    return top.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_rh")) - 1)


def high_market_concentration(df, n, p):
    t = "high_market_concentration"
    b, c, s = p.buyer, p.category, p.supplier
    base = df.filter(F.col(b).isNotNull() & F.col(c).isNotNull())
    grp = base.groupBy(b, c).agg(F.count(F.lit(1)).alias("_gsize"), F.count_distinct(s).alias("_gsup")) \
              .filter((F.col("_gsize") >= 3) & (F.col("_gsup") > 1))
    chosen = _take_groups(grp.crossJoin(F.broadcast(n)), [b, c], t, (F.col("_n") / 3).cast("bigint"), p)
    rows = stage(base.select(p.key, b, c, s).join(chosen.select(b, c), [b, c], "left_semi"), "rows-of-groups")
    # dominant supplier: the group's supplier with the smallest hash
    sup = rows.select(b, c, s).filter(F.col(s).isNotNull()).distinct() \
              .withColumn("_sh", _h(b, c, s, p=p, salt=t + ":s")) \
              .groupBy(b, c).agg(F.min_by(s, "_sh").alias("_dominant"))
    top = _take_in_group(rows, [b, c], t, 3, p).join(sup, [b, c])
    return _shape(top, t, p, titulaire_id=F.col("_dominant"))


def temporal_clustering(df, n, p):
    t = "temporal_clustering"
    keys = [p.buyer, p.supplier, p.category]
    cond = parse_date(p.date).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    base = df.filter(cond)
    grp = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_gsize")).filter(F.col("_gsize") >= 2)
    chosen = _take_groups(grp.crossJoin(F.broadcast(n)), keys, t,
                          F.greatest(F.lit(1), (F.col("_n") / 4).cast("bigint")), p)
    rows = base.select(p.key, *keys).join(chosen.select(*keys, "_gsize"), keys)
    top = _take_in_group(rows, keys, t, 4, p)
    # slots 0..3 cycle over the (≤ 4) templates: slot s uses rank s % size
    m = F.least(F.col("_gsize"), F.lit(4))
    slots = F.filter(F.array(*[F.lit(i) for i in range(4)]), lambda s: s % m == F.col("_rank"))
    ex = top.withColumn("_slot", F.explode(slots))
    month = F.floor(_u(*keys, p=p, salt=t + ":month") * dbl(12)).cast("int") + 1
    day = F.floor(_u(*keys, p=p, salt=t + ":day") * dbl(28)).cast("int") + 1
    base_date = F.make_date(F.lit(2023), month, day)
    off = F.floor(_u(p.key, F.col("_slot"), p=p, salt=t + ":off") * dbl(30)).cast("int")
    new_date = F.date_format(F.date_add(base_date, off), "yyyy-MM-dd")
    return _shape(ex, t, p, slot=F.col("_slot"), dateNotification=new_date)


def suspicious_buyer_supplier_pairs(df, n, p):
    t = "suspicious_buyer_supplier_pairs"
    b, s, a = p.buyer, p.supplier, p.amount
    pt = stage(df.filter(F.col(b).isNotNull() & F.col(s).isNotNull()).groupBy(b, s).agg(
        F.coalesce(F.sum(a), dbl(0)).alias("_psum"), F.count(a).alias("_pcnt")), "pairs")
    st = pt.agg(F.avg("_psum").alias("_pm"), F.stddev_samp("_psum").alias("_ps"))   # one row
    thr = F.col("_pm") + dbl(2) * F.col("_ps")
    elig = pt.crossJoin(F.broadcast(st)).filter(
        (F.col("_ps") > 0) & (F.col("_psum") < thr) & (F.col("_pcnt") >= 2) & (F.col("_psum") > 0)) \
        .withColumn("_thr", thr)
    chosen = _take_groups(elig.crossJoin(F.broadcast(n)), [b, s], t, (F.col("_n") / 2).cast("bigint"), p)
    factor = F.col("_thr") * (dbl(1.1) + _u(b, s, p=p, salt=t + ":f") * dbl(0.3)) / F.col("_psum")
    chosen = chosen.select(b, s, factor.alias("_factor"))
    rows = df.select(p.key, b, s, a).join(chosen, [b, s])
    top = _take_in_group(rows, [b, s], t, 2, p)
    amt = F.col(a)
    return _shape(top, t, p, montant=F.when(amt.isNotNull() & (amt > 0), amt * F.col("_factor")))


GENERATORS = {
    "single_bid_competitive": single_bid,
    "price_inflation": price_inflation,
    "price_deflation": price_deflation,
    "procedure_manipulation": procedure_manipulation,
    "suspicious_modifications": suspicious_modifications,
    "high_market_concentration": high_market_concentration,
    "temporal_clustering": temporal_clustering,
    "excessive_subcontracting": excessive_subcontracting,
    "short_contract_duration": short_contract_duration,
    "suspicious_buyer_supplier_pairs": suspicious_buyer_supplier_pairs,
}


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder.  The generators read their
    input some thirty times; writing it once (and cutting the lineage, so a
    lost executor re-reads files instead of recomputing the joins) is cheaper
    than recomputing the contract view for each read."""
    return stage(df, "inject")


def candidates(df: DataFrame, types: Sequence[str] = TYPES, p: InjectParams = InjectParams(),
               materialized: bool = False) -> DataFrame:
    if not materialized:
        df = materialize(df)
    n = per_type_count(df, len(types), p)
    rows = [t for t in types if t in ROW_TYPES]
    frames = [row_candidates(df, n, p, rows)] if rows else []
    frames += [GENERATORS[t](df, n, p) for t in types if t not in ROW_TYPES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _resolve(cands: DataFrame, types: Sequence[str], p: InjectParams) -> DataFrame:
    """One winner per uid: the type latest in ``types``, then the last slot."""
    order = F.create_map(*[x for i, t in enumerate(types) for x in (F.lit(t), F.lit(i))])
    c = cands.withColumn("_ord", order[F.col("anomaly_type")])
    newc = [f"new_{k}" for k in NEW_COLS]
    return c.groupBy(p.key).agg(F.max_by(F.struct("anomaly_type", "type_code", *newc),
                                         F.struct("_ord", "slot")).alias("_w")) \
            .select(p.key, "_w.*")


def inputs(p: InjectParams = InjectParams()) -> list[str]:
    """The columns that the types read or change."""
    return list(dict.fromkeys([p.key, p.buyer, p.supplier, p.category, p.amount, p.duration, p.date, *NEW_COLS]))


def inject_replace(df: DataFrame, types: Sequence[str] = TYPES, p: InjectParams = InjectParams()) -> DataFrame:
    """Same rows; templates overwritten in place; labels added.  Who reads the
    result more than once writes the columns that it reads."""
    df = materialize(df)
    win = _resolve(candidates(df, types, p, materialized=True), types, p)
    j = df.join(win, p.key, "left")
    sets = {k: F.when(F.col("type_code").isNotNull() & F.col(f"new_{k}").isNotNull(), F.col(f"new_{k}"))
                .otherwise(F.col(k)) for k in NEW_COLS if k in df.columns}
    out = j.withColumns(sets).withColumn("is_synthetic_anomaly", F.coalesce("type_code", F.lit(0))) \
           .drop("type_code", *[f"new_{k}" for k in NEW_COLS])
    return out


def inject_append(df: DataFrame, types: Sequence[str] = TYPES, p: InjectParams = InjectParams()) -> DataFrame:
    """Original rows (label 0) plus one new row per candidate, keyed
    ``uid#type#slot``, tagged ``source_type='synthetic'``."""
    df = materialize(df)
    cands = candidates(df, types, p, materialized=True)
    new = cands.join(df, p.key)
    sets = {k: F.coalesce(F.col(f"new_{k}"), F.col(k)) for k in NEW_COLS if k in df.columns}
    new = new.withColumns(sets).withColumn(
        p.key, F.concat_ws("#", F.col(p.key), F.col("anomaly_type"), F.col("slot").cast("string"))) \
        .withColumn("is_synthetic_anomaly", F.col("type_code")).withColumn("source_type", F.lit("synthetic")) \
        .select(*df.columns, "is_synthetic_anomaly", "anomaly_type", "source_type")
    orig = df.withColumn("is_synthetic_anomaly", F.lit(0))
    return orig.unionByName(new, allowMissingColumns=True)


def injection_summary(labelled: DataFrame) -> DataFrame:
    """Count and % per injected type (code ↔ name from the fixed table)."""
    from bidscope.functions.columns import pct
    labelled = stage(labelled.select("is_synthetic_anomaly"), "labels")
    codes = labelled.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(TYPES)],
                                                  "is_synthetic_anomaly int, anomaly_name string")
    tot = labelled.agg(F.count(F.lit(1)).alias("_tot"))
    c = labelled.filter(F.col("is_synthetic_anomaly") > 0).groupBy("is_synthetic_anomaly") \
                .agg(F.count(F.lit(1)).alias("n_rows"))
    return c.join(F.broadcast(codes), "is_synthetic_anomaly").crossJoin(F.broadcast(tot)) \
            .select("is_synthetic_anomaly", "anomaly_name", "n_rows",
                    F.round(pct("n_rows", "_tot"), 6).alias("percentage"))
