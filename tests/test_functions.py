"""Hand-worked edge cases (FIXTURES F7) for scalar functions and filters."""

from pyspark.sql import functions as F

from bidscope.functions import columns as FN
from bidscope.operators import clean as C


def test_cpv_level_levels(spark):
    df = spark.createDataFrame([("03111900-1",)], "c string")
    row = df.select(*[FN.cpv_level("c", lv).alias(f"l{lv}") for lv in (2, 3, 4, 5)]).first()
    assert (row.l2, row.l3, row.l4, row.l5) == ("03000000", "03100000", "03110000", "03111000")


def test_cpv_level_edge(spark):
    df = spark.createDataFrame([(" 45 ",), ("123456789",), (None,)], "c string")
    got = [r[0] for r in df.select(FN.cpv_level("c", 2)).collect()]
    assert got == ["45000000", "12000000", None]


def test_cpv_level_bad_level():
    import pytest
    with pytest.raises(ValueError):
        FN.cpv_level("c", 6)


def test_cpv_2_3(spark):
    df = spark.createDataFrame([("45213000-1",), ("71300000-2",), ("03111900-1",)], "c string")
    got = [r[0] for r in df.select(FN.cpv_2_3("c")).collect()]
    assert got == ["45200000", "71300000", "03000000"]


def test_filter_amount_keeps_null(spark):
    df = spark.createDataFrame([(19999.0,), (20000.0,), (5e7,), (50000001.0,), (None,)], "montant double")
    got = sorted([r[0] for r in C.filter_amount(df).collect()], key=lambda x: (x is None, x))
    assert got == [20000.0, 5e7, None]


def test_bin_fixed_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.001,), (0.05,), (0.15,), (1.0,), (1.5,), (None,)], "t double")
    got = [r[0] for r in df.select(FN.bin_fixed("t")).collect()]
    assert got == ["no_advance", "no_advance", "small_advance", "medium_advance", "large_advance", None, None]


def test_bin_ranges(spark):
    df = spark.createDataFrame([(0.0,), (25000.0,), (1000000.0,), (-1.0,), (None,)], "m double")
    assert [r[0] for r in df.select(FN.bin_ranges("m")).collect()] == [0, 1, 4, 4, 4]


def test_status_buckets(spark):
    df = spark.createDataFrame([(11.0,), (6.0,), (2.0,), (0.5,), (0.1,)], "p double")
    got = [r[0] for r in df.select(FN.prevalence_status("p")).collect()]
    assert got == ["Very High", "High", "Medium", "Low", "Very Low"]


def test_md5_uniform_range_and_determinism(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("uid"))
    a = df.select(FN.md5_uniform("uid", seed=42).alias("u"))
    r = a.agg(F.min("u"), F.max("u")).first()
    assert 0.0 <= r[0] < r[1] < 1.0
    assert a.collect() == df.select(FN.md5_uniform("uid", seed=42).alias("u")).collect()


def test_parse_date_guards_years(spark):
    df = spark.createDataFrame([("2021-03-04",), ("0204-04-24",), ("garbage",)], "d string")
    got = [r[0] for r in df.select(FN.parse_date("d")).collect()]
    assert str(got[0]) == "2021-03-04" and got[1] is None and got[2] is None


def test_readable_names(spark):
    from bidscope.functions.columns import readable_feature
    rows = {"other_num_pipeline__montant": "Montant (€)", "cat_pipeline__codeCPV_2_3_45": "CPV: 45", "cat_pipeline__nature_a_b": "Nature: a_b", "else": "else"}
    df = spark.createDataFrame([(k,) for k in rows], "n string")
    assert {r.n: r.s for r in df.select("n", readable_feature(F.col("n")).alias("s")).collect()} == rows
