"""Run registered plans in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/oracle_check.py [sf_dir] [name ...]

Checks row count, column names + type classes, and sorted row values
(exact; a float-tolerant second look is reported separately).
"""

from __future__ import annotations

import math
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bidscope.plans.registry import load_all  # noqa: E402
from bidscope.session import get_session  # noqa: E402
from bidscope.sources.tables import TABLES, table_path  # noqa: E402

SPARK_T = {"LongType": "i64", "IntegerType": "i32", "DoubleType": "f64", "StringType": "str",
           "BooleanType": "bool", "DateType": "date", "FloatType": "f32", "ShortType": "i16",
           "ByteType": "i8", "TimestampType": "ts", "TimestampNTZType": "ts"}
DUCK_T = {"BIGINT": "i64", "INTEGER": "i32", "DOUBLE": "f64", "VARCHAR": "str", "BOOLEAN": "bool",
          "DATE": "date", "FLOAT": "f32", "SMALLINT": "i16", "TINYINT": "i8", "TIMESTAMP": "ts"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def close(a, b):
    if a == b:
        return True
    if isinstance(a, float) and isinstance(b, (float, int)) or isinstance(b, float) and isinstance(a, (float, int)):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, tuple) and isinstance(b, tuple) and len(a) == len(b):
        return all(close(x, y) for x, y in zip(a, b))
    return False


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    plans = load_all()
    spark = get_session(checkpoint=tempfile.mkdtemp(prefix="bidscope-tool-"))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    summary = {"ok": [], "approx": [], "fail": [], "rows_only": [], "error": []}
    for name, p in plans.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = p.build(spark, sf)
            srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
            scols = sdf.columns
            stypes = [SPARK_T.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in sdf.schema.fields]
        except Exception as e:  # noqa: BLE001
            summary["error"].append(name)
            print(f"ERROR spark {name}: {str(e)[:600]}")
            continue
        ts = time.time() - t0
        if p.oracle is None:
            summary["rows_only"].append(name)
            print(f"rows-only {name}: {len(srows)} rows {ts:.1f}s")
            continue
        try:
            cur = con.execute(p.oracle)
            dcols = [d[0] for d in cur.description]
            dtypes = [DUCK_T.get(str(d[1]), str(d[1])) for d in cur.description]
            drows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            summary["error"].append(name)
            print(f"ERROR duckdb {name}: {str(e)[:600]}")
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"columns spark={scols} duck={dcols}")
        else:
            sm = dict(zip(scols, stypes))
            dm = dict(zip(dcols, dtypes))
            tdiff = {c: (sm[c], dm[c]) for c in scols if sm[c] != dm[c]}
            if tdiff:
                problems.append(f"types {tdiff}")
        if len(srows) != len(drows):
            problems.append(f"rows spark={len(srows)} duck={len(drows)}")
        status = "ok"
        if not problems:
            order = sorted(range(len(scols)), key=lambda i: scols[i])
            dorder = [dcols.index(scols[i]) for i in order]
            a = sorted((tuple(r[i] for i in order) for r in srows), key=key)
            b = sorted((tuple(r[i] for i in dorder) for r in drows), key=key)
            if a != b:
                if all(close(x, y) for x, y in zip(a, b)):
                    status = "approx"
                else:
                    status = "fail"
                    for x, y in zip(a, b):
                        if not close(x, y):
                            problems.append(f"first diff spark={x} duck={y}")
                            break
        else:
            status = "fail"
        summary[status].append(name)
        print(f"{status:6s} {name}: {len(srows)} rows {ts:.1f}s {'; '.join(problems)[:800]}")
    print({k: len(v) for k, v in summary.items()})
    for k in ("approx", "fail", "error"):
        if summary[k]:
            print(k, summary[k])


if __name__ == "__main__":
    main()
