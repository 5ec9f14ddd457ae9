"""Joins: CPV descriptions, registry enrichment, key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.session import stage_small as stage


def cpv_anti(df: DataFrame, cpv: DataFrame, col: str = "codeCPV") -> DataFrame:
    """Distinct codes of ``df`` absent from the list."""
    codes = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return codes.join(cpv.select(F.col("CODE").alias(col)), col, "left_anti")


def cpv_semi(df: DataFrame, cpv: DataFrame, col: str = "codeCPV") -> DataFrame:
    """Distinct codes of ``df`` present in the list."""
    codes = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return codes.join(cpv.select(F.col("CODE").alias(col)), col, "left_semi")


def code_prefixes(cpv: DataFrame, order: str = "CODE", lengths: DataFrame | None = None) -> DataFrame:
    """(prefix, CODE, place) for every prefix of every list code: turns the
    ``startswith`` theta join into an equi join on ``prefix``.  ``place`` is
    the code's place in the list, by the column ``order``; ``lengths`` (rows
    _len) keeps to prefixes of these lengths."""
    listed = cpv.filter(F.length("CODE") > 0).select("CODE", F.col(order).alias("place"))
    if lengths is None:
        made = listed.withColumn("_len", F.explode(F.sequence(F.lit(1), F.length("CODE"))))
    else:
        made = listed.crossJoin(F.broadcast(lengths)).filter((F.col("_len") > 0) & (F.col("_len") <= F.length("CODE")))
    return made.select(F.expr("substring(CODE, 1, _len)").alias("prefix"), "CODE", "place")


def cpv_prefix_match(missing: DataFrame, cpv: DataFrame, col: str = "codeCPV", order: str = "CODE") -> DataFrame:
    """For each missing code: the first list code starting with it
    (``new_CPV``, null when none) and how many list codes start with it
    (``count_similar``).  ``order`` is the column that says a code's place in
    the list: a list read from a file carries its line number, a list that is
    kept in code order needs none.

    Only prefixes as long as some missing code are made, and they are counted
    before the join: one row per prefix, of a size that is known by then."""
    missing = missing.select(col).distinct()
    lengths = missing.select(F.length(col).alias("_len")).distinct()        # at most as many as a code has characters
    pref = code_prefixes(cpv, order, lengths).groupBy("prefix").agg(
        F.count("CODE").alias("count_similar"), F.min_by("CODE", F.struct("place", "CODE")).alias("new_CPV"))
    j = missing.join(pref, F.col(col) == F.col("prefix"), "left")
    return j.select(col, F.coalesce("count_similar", F.lit(0).cast("long")).alias("count_similar"), "new_CPV")


def cpv_mapping(df: DataFrame, cpv: DataFrame, col: str = "codeCPV", order: str = "CODE") -> DataFrame:
    """code → description: exact matches ∪ prefix matches of missing codes.
    A code that the list has twice keeps its first description.

    ``df`` is read once, for its distinct codes.  Codes and list may both have
    a row per article: the joins' lookup sides come out of a shuffle, so that
    they are broadcast by their measured size, not by that of a packed file."""
    cpv = cpv.groupBy("CODE").agg(F.min(F.struct(F.col(order).alias("place"), "FR")).alias("_first")) \
             .select("CODE", F.col("_first.place").alias("place"), F.col("_first.FR").alias("FR"))
    codes = df.select(col).filter(F.col(col).isNotNull()).distinct()
    known = cpv.select(F.col("CODE").alias(col), "FR", F.lit(True).alias("_known"))
    told = stage(codes.join(known, col, "left"), "codes")
    exact = told.filter("_known").select(col, F.col("FR").alias("codeCPV_FR"))
    pm = cpv_prefix_match(told.filter("_known IS NULL"), cpv, col, "place")
    prefix = pm.join(cpv.select(F.col("CODE").alias("new_CPV"), "FR"), "new_CPV", "left") \
        .select(col, F.col("FR").alias("codeCPV_FR"))
    return exact.unionByName(prefix)


def cpv_description(df: DataFrame, cpv: DataFrame, col: str = "codeCPV", order: str = "CODE") -> DataFrame:
    """Adds ``codeCPV_FR`` (left join: rows without a code keep a null)."""
    mapping = cpv_mapping(df, cpv, col, order).repartition(col)      # measured before it may be broadcast
    return df.join(mapping, col, "left")


def enrich_registry(df: DataFrame, registry: DataFrame, buyer_key: str = "acheteur_siren",
                    supplier_key: str = "titulaire_siren", buyer_prefix: str = "",
                    supplier_prefix: str = "") -> DataFrame:
    """Two left joins to one pruned registry scan; payload renamed per role."""
    reg = registry.select("siren", "categorieEntreprise", "trancheEffectifsUniteLegale")
    b = reg.select(F.col("siren").alias("_bk"),
                   F.col("trancheEffectifsUniteLegale").alias("acheteur_tranche_effectif"),
                   F.col("categorieEntreprise").alias("acheteur_categorie"))
    s = reg.select(F.col("siren").alias("_sk"),
                   F.col("trancheEffectifsUniteLegale").alias("titulaire_tranche_effectif"),
                   F.col("categorieEntreprise").alias("titulaire_categorie"))
    out = df.withColumn("_bk", F.concat(F.lit(buyer_prefix), F.col(buyer_key).cast("string"))) \
            .withColumn("_sk", F.concat(F.lit(supplier_prefix), F.col(supplier_key).cast("string")))
    return out.join(b, "_bk", "left").join(s, "_sk", "left").drop("_bk", "_sk")


def membership_join(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is in ``keys`` (semi join; AQE broadcasts small key sets)."""
    return df.join(keys, on, "left_semi")


def group_stats_join(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per-group mean / sample std attached to every row (aggregate + join,
    not a window: a hot group is pre-aggregated on the map side)."""
    st = df.groupBy(group).agg(F.avg(value).alias("group_mean"), F.stddev_samp(value).alias("group_std"))
    return df.join(st, group, "left")


def pair_join_back(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")
