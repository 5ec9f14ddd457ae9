"""Scans of the driver tables and the derived ``contracts`` view.

The contract model (uid, buyer, supplier, amount, CPV code, procedure, ...)
is declared as one lazy join of lineitem, orders, part, customer and
supplier.  No join is hinted: the dimension tables grow with the scale
factor, so the physical strategy is left to Catalyst/AQE, which broadcasts a
side only after measuring it at runtime.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.columns import cpv_code_from_part

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Procedure names used by the red-flag rules and the mapping of
# order priorities onto them (see SURVEY §1.1).
PROC_OPEN = "Appel d'offres ouvert"
PROC_RESTRICTED = "Appel d'offres restreint"
PROC_ADAPTED = "Procédure adaptée"
PROC_NEGOTIATED_NO_PUB = "Marché négocié sans publicité"
PROC_NEGOTIATED = "Procédure avec négociation"
COMPETITIVE_PROCEDURES = (PROC_OPEN, PROC_RESTRICTED)
NON_COMPETITIVE_PROCEDURES = (PROC_ADAPTED, PROC_NEGOTIATED_NO_PUB)
PRIORITY_TO_PROCEDURE = {
    "5-LOW": PROC_OPEN,
    "4-NOT SPECIFIED": PROC_RESTRICTED,
    "3-MEDIUM": PROC_ADAPTED,
    "2-HIGH": PROC_NEGOTIATED_NO_PUB,
}

CONTRACT_SCHEMA = T.StructType([
    T.StructField("uid", T.StringType(), False),
    T.StructField("acheteur_id", T.StringType()),
    T.StructField("acheteur_siren", T.StringType()),
    T.StructField("acheteur_region", T.StringType()),
    T.StructField("titulaire_id", T.StringType()),
    T.StructField("titulaire_siren", T.StringType()),
    T.StructField("montant", T.DoubleType()),
    T.StructField("codeCPV", T.StringType()),
    T.StructField("procedure", T.StringType()),
    T.StructField("categorie", T.StringType()),
    T.StructField("dureeMois", T.DoubleType()),
    T.StructField("offresRecues", T.DoubleType()),
    T.StructField("tauxAvance", T.DoubleType()),
    T.StructField("sousTraitanceDeclaree", T.DoubleType()),
    T.StructField("idAccordCadre", T.StringType()),
    T.StructField("nature", T.StringType()),
    T.StructField("formePrix", T.StringType()),
    T.StructField("ccag", T.StringType()),
    T.StructField("typeGroupementOperateurs", T.StringType()),
    T.StructField("origineFrance", T.DoubleType()),
    T.StructField("marcheInnovant", T.DoubleType()),
    T.StructField("dateNotification", T.StringType()),
])
CONTRACT_COLUMNS = [f.name for f in CONTRACT_SCHEMA.fields]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    """Parquet scan; an explicit column list becomes the scan's ReadSchema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns is not None else df


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail before any job runs when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def _dbl(x: float) -> Column:
    return F.lit(float(x))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract table built from the TPC-H-like driver tables."""
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    o = read_table(spark, sf_dir, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])

    # customers meet orders, not the lines of orders, of which there are more
    j = (li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey))

    code = cpv_code_from_part()
    procedure = F.lit(PROC_NEGOTIATED)
    for prio, proc in reversed(list(PRIORITY_TO_PROCEDURE.items())):
        procedure = F.when(F.col("o_orderpriority") == prio, F.lit(proc)).otherwise(procedure)
    null_d = F.lit(None).cast("double")
    null_s = F.lit(None).cast("string")

    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("uid"),
        F.col("o_custkey").cast("string").alias("acheteur_id"),
        F.col("o_custkey").cast("string").alias("acheteur_siren"),
        F.col("c_nationkey").cast("string").alias("acheteur_region"),
        F.col("s_nationkey").cast("string").alias("titulaire_id"),
        F.col("l_suppkey").cast("string").alias("titulaire_siren"),
        (F.col("l_extendedprice") * F.col("l_quantity") * (_dbl(1) - F.col("l_discount"))).alias("montant"),
        code.alias("codeCPV"),
        procedure.alias("procedure"),
        F.col("p_type").alias("categorie"),
        F.when(F.col("l_linenumber") == 7, null_d)
         .when(F.col("p_size") <= 2, F.col("p_size").cast("double") * _dbl(0.25))
         .otherwise(F.col("p_size").cast("double")).alias("dureeMois"),
        F.when(F.col("l_linenumber") == 6, null_d)
         .otherwise(F.col("l_linenumber").cast("double")).alias("offresRecues"),
        F.when(F.col("l_tax") == _dbl(0.08), null_d)
         .otherwise(F.col("l_tax") * _dbl(4)).alias("tauxAvance"),
        F.when(F.col("l_returnflag") == "R", _dbl(1))
         .when(F.col("l_returnflag") == "A", _dbl(0)).otherwise(null_d).alias("sousTraitanceDeclaree"),
        F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey").cast("string"))
         .otherwise(null_s).alias("idAccordCadre"),
        F.col("l_linestatus").alias("nature"),
        F.col("c_mktsegment").alias("formePrix"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("ccag"),
        F.col("o_orderstatus").alias("typeGroupementOperateurs"),
        F.when(F.col("s_nationkey") % 5 == 0, _dbl(1)).otherwise(_dbl(0)).alias("origineFrance"),
        F.when(F.col("p_size") % 7 == 0, _dbl(1)).otherwise(_dbl(0)).alias("marcheInnovant"),
        F.col("o_orderdate").cast("date").cast("string").alias("dateNotification"),
    )


def contracts_staged(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The contract view, or the ``columns`` of it that a plan reads, written
    once to the shared folder (for plans that read it many times; see
    ``session.stage``).  Its joins move and keep these columns only."""
    from bidscope.session import stage_small as stage
    c = contracts(spark, sf_dir)
    return stage(c.select(*columns) if columns is not None else c, "contracts")


def cpv_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference CPV list (CODE, FR): the code of every part, except the ones
    whose check digit is 3, so that some contract codes are missing.
    List order is code order, so "first entry" is the smallest CODE."""
    codes = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"]).select(
        cpv_code_from_part().alias("CODE")).distinct()
    return (codes.filter(~F.col("CODE").endswith("-3"))
                 .withColumn("FR", F.concat(F.lit("Libellé "), F.col("CODE"))))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company registry (siren, categorieEntreprise, trancheEffectifsUniteLegale)
    from customer ∪ supplier; keys carry a role prefix since ids overlap."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"]).select(
        F.concat(F.lit("B"), F.col("c_custkey").cast("string")).alias("siren"),
        F.col("c_mktsegment").alias("categorieEntreprise"),
        F.lpad((F.col("c_custkey") % 54).cast("string"), 2, "0")
         .alias("trancheEffectifsUniteLegale"))
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"]).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("siren"),
        F.when(F.col("s_nationkey") % 3 == 0, F.lit("PME"))
         .when(F.col("s_nationkey") % 3 == 1, F.lit("ETI")).otherwise(F.lit("GE"))
         .alias("categorieEntreprise"),
        F.lpad((F.col("s_suppkey") % 54).cast("string"), 2, "0")
         .alias("trancheEffectifsUniteLegale"))
    return cust.unionByName(supp)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV, no index column; the path is always explicit."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
