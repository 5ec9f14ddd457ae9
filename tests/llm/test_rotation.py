"""Rotation against a plain version; the SQL twin is compared as well."""
import duckdb

from bidscope.llm import rotation as R
from bidscope.llm.queries import ORACLES, QUERIES


def plain(rows, piece):
    out = []
    none = lambda x: (x is not None, x or 0 if not isinstance(x, str) else x)
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        for who in {r[2] for r in own} - {None, "system"}:
            pieces = {}
            for r in sorted(own, key=lambda r: (none(r[1]), r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
                pieces.setdefault((r[1] or 0) // piece, []).append(r)
            for k, turns in pieces.items():
                text, spans = "", []
                for _, _, role, said in turns:
                    shown = "system" if role == "system" else "assistant" if role == who else f"user name={role or 'unknown'}"
                    text += f"<|im_start|>{shown}\n"
                    begin = len(text)
                    text += (said or "") + "<|im_end|>\n"
                    if shown == "assistant":
                        spans.append((begin, len(text)))
                out.append((conv, who, k, len(turns), text, spans))
    return sorted(map(str, out))


def test_against_plain(spark):
    rows = [(1, 0, "system", "be é"), (1, 1, "ann", "hi"), (1, 2, "bob", "漢字"), (1, 3, "cy", None), (1, 4, "ann", ""), (1, 4, "ann", ""),
            (2, 0, "system", "alone"), (3, None, "ann", "x"), (3, 0, None, "y"), (None, 0, "ann", "z"), (None, 1, "bob", "w")]
    rows += [(4, i, "ab"[i % 2], f"t{i} " * (2000 if i == 7 else 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as piece", "2 as perspective")
    got = [(r.conv_id, r.perspective, r.piece, r.n_turns, r.dialogue, [tuple(s) for s in r.spans]) for r in R.rotate(df).collect()]
    assert sorted(map(str, got)) == plain(rows, R.PIECE)
    assert R.rotate(df.limit(0)).count() == 0


def test_sql_twin_and_no_python(spark):
    d = "/root/testdata/sf0.001"
    out = QUERIES["op9_rotation"](spark, d)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    want = con.sql(ORACLES["op9_rotation"])
    assert want.columns == out.columns
    assert sorted(map(tuple, out.collect())) == sorted(want.fetchall())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
