"""§2.1 scans, sources and sinks."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from bidscope.plans.oracle import CPV_CODES_SELECT, with_contracts
from bidscope.plans.registry import plan
from bidscope.session import scratch_path
from bidscope.sources import tables as S


def _tag(sf_dir: str) -> str:
    return hashlib.md5(sf_dir.encode()).hexdigest()[:8]


@plan("scan_table", with_contracts("SELECT * FROM contracts"), "2.1")
def scan_table(spark, sf):
    return S.contracts(spark, sf)


@plan("scan_pruned", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer", "2.1")
def scan_pruned(spark, sf):
    # 3 of the customer columns: ReadSchema of the scan holds only these
    return S.read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])


@plan("require_columns", with_contracts(
    "SELECT uid, acheteur_id, titulaire_id, montant, codeCPV FROM contracts"), "2.1")
def require_columns(spark, sf):
    need = ["uid", "acheteur_id", "titulaire_id", "montant", "codeCPV"]
    return S.require_columns(S.contracts(spark, sf), need).select(*need)


@plan("scan_csv", CPV_CODES_SELECT, "2.1")
def scan_csv(spark, sf):
    """The CPV list as the reference keeps it (a header CSV), written once
    to the shared folder and scanned back with an explicit schema."""
    from pyspark.sql import types as T
    path = scratch_path(spark, f"cpv_csv_{_tag(sf)}")
    S.write_csv(S.cpv_codes(spark, sf), path)
    schema = T.StructType([T.StructField("CODE", T.StringType()), T.StructField("FR", T.StringType())])
    return S.scan_csv(spark, path, schema)


@plan("sink_csv", with_contracts(
    "SELECT uid, acheteur_id, titulaire_id, montant, codeCPV, dureeMois, dateNotification FROM contracts"), "2.1")
def sink_csv(spark, sf):
    cols = ["uid", "acheteur_id", "titulaire_id", "montant", "codeCPV", "dureeMois", "dateNotification"]
    df = S.contracts(spark, sf).select(*cols)
    path = scratch_path(spark, f"contracts_csv_{_tag(sf)}")
    S.write_csv(df, path)
    return S.scan_csv(spark, path, df.schema)


@plan("sink_splits", with_contracts("""
SELECT uid, categorie, CASE WHEN u < CAST(0.2 AS DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT uid, categorie, (CAST(('0x' || substr(md5(uid || ':' || '42'), 1, 7)) AS BIGINT)
                          / CAST(268435456 AS DOUBLE)) AS u FROM contracts) t"""), "2.1")
def sink_splits(spark, sf):
    from bidscope.operators.clean import split_random
    df = split_random(S.contracts(spark, sf).select("uid", "categorie"), 0.2, 42)
    path = scratch_path(spark, f"splits_{_tag(sf)}")
    S.write_parquet(df, path, partition_by=["split"])
    return spark.read.parquet(path).select("uid", "categorie", F.col("split").cast("string"))
