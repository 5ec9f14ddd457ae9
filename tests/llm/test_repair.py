"""Repair against plain shortest paths over whole audits."""
import hashlib
import heapq
import random
import re
import zlib

from bidscope.llm import repair as R

SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """rows in order: (turn, role, text) -> counts, cost, audit, digest."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    heap, done = [(0, "", 0, "", ())], set()      # Dijkstra: cheapest, then ASCII-least
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            text = "\n".join(f"{a}:{b}" for a, b in out)
            return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()
        tail = "" if not roles else roles[-1]
        if (at, tail) in done:
            continue
        done.add((at, tail))
        fits = {"": "su", "s": "u", "u": "a", "a": "u"}[tail]
        for name in ("user", "assistant"):
            if name[0] in fits:
                heapq.heappush(heap, (cost + 3, audit + "I", at, roles + name[0], (*out, (name, ""))))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, out))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 * (faults[at] == "truncated")
                if role[:1] and role[:1] in fits:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + role[:1], (*out, (role, text))))
                for name in ("user", "assistant"):
                    if name[0] in fits:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, roles + name[0], (*out, (name, text))))


def broken(rows):
    """The damage, row by row, and each conversation's rows in order."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    said = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()
    return {c: sorted(o, key=lambda r: (r[0] is not None, r[0] or 0, r[1], said(r))) for c, o in convs.items()}


def made(rng, conv, n):
    texts = ["Fine.", "half", "Yes!", "x y.", " ", "", None, "who?", "café.", "a\nb", " ", "漢字。"]
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, "", "User"]
    return [(conv, rng.choice([None, i, i, i, i, i // 2, i + 7]), rng.choice(roles), rng.choice(texts + [f"t{i}."] * 20)) for i in range(n)]


def run(spark, rows, **parameters):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as audit", "'z' as whole")
    got = R.digest(df, *R.repair(R.damage(df), **parameters))
    return {r.conv_id: tuple(r)[1:7] + (r.audit, r.repaired_sha256) for r in got.collect()}


def expected(rows):
    out = {}
    for conv, own in broken(rows).items():
        gaps, blank, duplicate, truncated, illegal, cost, audit, sha = plain(own)
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)
    return out


def test_against_plain(spark):
    rng = random.Random(5)
    rows = [r for conv in [None, -3, *range(150)] for r in made(rng, conv, rng.randrange(1, 9))]
    rows += made(rng, 1000, 400) + [(2000, i, "user", "same.") for i in range(300)] + [(2001, 1, "user", "same.")] * 300
    rows += [(3000, i, ["user", "assistant"][i % 2], "long " * 60_000 + f"{i}.") for i in range(6)]
    assert run(spark, rows) == expected(rows)
    assert run(spark, rows[:0]) == {}


def test_conversations_in_many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(6)
        rows = made(rng, 1, 900) + made(rng, 2, 5) + made(rng, 3, 700) + [(4, i, "assistant", f"{i}") for i in range(500)]
        assert run(spark, rows, chunk_rows=7) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_powers_are_repeated_products():
    for symbol in "suaxSUAXd":
        m = R.IDENTITY
        for n in range(1, 20):
            m = R.multiply(m, R.power(symbol, 0))
            assert m == R.matrix([(symbol, n)])
            v, least = R.advance(symbol, n, R.closing(R.ACCEPT, True))
            assert tuple(x + least for x in v) == R.costs_before(m, R.closing(R.ACCEPT, True))
