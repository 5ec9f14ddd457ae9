"""The trie against a plain one of nested prefixes."""
import hashlib
import random
import zlib

import pytest

from bidscope.llm import prefixtrie as P


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()
    turns = {c: [r[2:] for r in sorted(t, key=lambda r: (r[:2], said(r)))] for c, t in turns.items()}
    built = {}
    for c, own in turns.items():
        base, h = c - int(abs(c) % 5) * (1 if c >= 0 else -1), zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own) if base == c else tuple(turns.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes.setdefault(t[:d], []).append(c)
    below, out = {}, {}
    for t in nodes:
        if t:
            below.setdefault(t[:-1], []).append(t)
    sums = {}
    for t in sorted(nodes, key=len, reverse=True):
        kids = below.get(t, [])
        saved = (len(nodes[t]) - 1) * (len(t[-1][1].encode()) if t else 0)
        sums[t] = (sum(sums[k][0] for k in kids) or 1, saved + sum(sums[k][1] for k in kids))
        ends = ",".join(str(c) for c in sorted(c for c in nodes[t] if built[c] == t))
        out[min(nodes[t]), len(t)] = (min(nodes[t[:-1]]) if t else None, len(nodes[t]), len(kids), *sums[t], hashlib.sha256(ends.encode()).hexdigest())
    return out


def run(spark, rows, **parameters):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as depth", "2 as size", "3 as k1")
    got = P.trie(*P.rebuild(P.number_turns(df)), **parameters).collect()
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in got}


def made(rng, convs):
    rows = []
    for conv in convs:
        for i in range(rng.randrange(1, 10)):
            rows.append((conv, rng.choice([None, i, i, i, i]), rng.choice(["user", "assistant", None]) if rng.random() < .1 else ["user", "assistant"][i % 2],
                         rng.choice(["a", "b", "é", "", None]) if rng.random() < .5 else "x" * i))
    return rows


@pytest.mark.parametrize("parameters", [{}, {"piece": 20, "block": 3}])
def test_against_plain(spark, parameters):
    rng = random.Random(3)
    rows = made(rng, [None, -7, -5, -1, *range(120), 10**12]) + [(200 + i, 0, "user", "same") for i in range(100)]
    rows += [(400, i, "user", f"t{i % 7}") for i in range(300)] + [(401, i, "user", f"t{i % 7}") for i in range(250)]
    rows += [(500, 1, "user", "again")] * 40 + [(505, 0, "user", "漢" * 100_000), (506, 0, "user", "漢" * 100_000)]
    assert run(spark, rows, **parameters) == plain(rows)


def test_no_rows(spark):
    assert run(spark, [], **{}) == {}


def test_centroids():
    rng = random.Random(4)
    for n in (1, 2, 7, 300):
        for shape in (lambda i: i - 1, lambda i: 0, lambda i: rng.randrange(max(0, i - 3), i), lambda i: rng.choice([-1, rng.randrange(i)])):
            up = [-1] + [shape(i) for i in range(1, n)]
            value = [rng.randrange(-5, 9) for _ in range(n)]
            want = list(value)
            for i in range(n - 1, 0, -1):
                if up[i] >= 0:
                    want[up[i]] += want[i]
            assert P.roll_up(up, [value, [1] * n])[0] == want
