"""Red-flag rules, graph and injection properties (FIXTURES F7, SURVEY §5)."""

import datetime as dt

from pyspark.sql import functions as F

from bidscope.operators import flags as FL
from bidscope.operators import graph as G

P = FL.RuleParams(category="cat")


def _rows(spark, amounts, cat="A"):
    return spark.createDataFrame([(str(i), cat, float(a)) for i, a in enumerate(amounts)],
                                 "uid string, cat string, montant double")


def test_price_inflation_zero_std(spark):
    df = _rows(spark, [100.0] * 200)
    assert FL.with_price_flags(df, P).filter("price_inflation").count() == 0


def test_price_inflation_small_group(spark):
    df = _rows(spark, [100.0] * 198 + [1e9])
    assert FL.with_price_flags(df, P).filter("price_inflation").count() == 0


def test_price_inflation_hit(spark):
    df = _rows(spark, [100.0 + (i % 5) for i in range(299)] + [1e9])
    assert [r.uid for r in FL.with_price_flags(df, P).filter("price_inflation").collect()] == ["299"]


def _dates(spark, days, key="g"):
    base = dt.date(2020, 1, 1)
    return spark.createDataFrame(
        [(str(i), key, key, key, (base + dt.timedelta(days=d)).isoformat()) for i, d in enumerate(days)],
        "uid string, b string, s string, c string, dateNotification string")


def test_burst_lead(spark):
    hit = FL.burst_groups(_dates(spark, [0, 10, 20, 30]), ["b", "s", "c"], "dateNotification", 30, 4)
    miss = FL.burst_groups(_dates(spark, [0, 10, 20, 31]), ["b", "s", "c"], "dateNotification", 30, 4)
    assert hit.count() == 1 and miss.count() == 0


def test_burst_members(spark):
    df = _dates(spark, [0, 0, 5, 14, 15, 40])
    got = sorted(r.uid for r in FL.burst_members(df, ["b", "s", "c"], "dateNotification", 15, 5).collect())
    assert got == ["0", "1", "2", "3", "4"]


def test_concentration_shares(spark):
    rows = []
    for g, (dom, tot) in {"x": (3, 4), "y": (2, 2), "z": (7, 10)}.items():
        rows += [(f"{g}{i}", g, "cpv", "S1" if i < dom else f"S{i + 2}") for i in range(tot)]
    df = spark.createDataFrame(rows, "uid string, acheteur_id string, cat string, titulaire_id string")
    keys = FL.concentration_keys(df, P).collect()
    assert [(k.acheteur_id, k.titulaire_id) for k in keys] == [("x", "S1")]


def test_graph_same_id_two_nodes(spark):
    df = spark.createDataFrame([("u1", "7", "7")], "uid string, acheteur_id string, titulaire_id string")
    nodes = G.graph_nodes(df).collect()
    assert sorted((n.id, n.node_type) for n in nodes) == [(0, 0), (1, 1)]


def test_message_pass_directed(spark):
    edges = spark.createDataFrame([("e1", 0, 1), ("e2", 0, 1)], "uid string, src long, dst long")
    state = spark.createDataFrame([(0, 0, 1.0), (1, 0, 10.0)], "id long, pos int, value double")
    got = {r.id: r.value for r in G.message_pass(edges, state, rounds=1, checkpoint=False).collect()}
    assert got == {0: 1.0, 1: 12.0}   # buyer receives nothing; supplier gets two messages
