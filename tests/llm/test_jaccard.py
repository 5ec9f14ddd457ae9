"""The T-occurrence join against all pairs."""
import random
import re

import numpy as np
import pytest

from bidscope.llm import jaccard as J


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None and sets[i]:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(str((k, len(sets[i]), least.get(find(i)) if sets[i] else k)) for i, (k, _) in enumerate(rows))


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts = [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    texts += [" ".join([word() for _ in range(rng.randrange(5, 120))] + passage) for _ in range(60)]
    for size in (90, 200, 60):
        base = [word() for _ in range(size)]
        texts += family(rng, base, 40, size // 25)
        chain = list(base)
        for i in range(0, size - 4, max(1, size // 40)):
            chain[i:i + 2] = [word(), word()]
            texts.append(" ".join(chain))
    texts += texts[:30] + ["a b c", "A B  c", "a b", "", " \n", "x"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_all_links(spark, monkeypatch, seed):
    rows = corpus(seed)
    monkeypatch.setattr(J, "HOME", 4000)      # many homes and salted ones
    got = J.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_edges(spark):
    rows = [(5, None), (4, ""), (3, "One two three four five six"), (2, "one two three four five six"), (2, "one two three four five six"),
            (None, "one two three four five six"), (None, "alone here"), (9, "word " * 50000), (7, "word " * 49999 + "end of it all here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as component_id", "1 as node", "2 as home")
    out = J.components(df)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(str(tuple(r)) for r in out.collect()) == brute(rows)
    assert J.components(df.limit(0)).count() == 0


def test_home_search_is_exact():
    rng = random.Random(4)
    for trial in range(30):
        sets = []
        for _ in range(6):
            base = rng.sample(range(10 ** 6), rng.randrange(5, 60))
            for _ in range(8):
                keep = [x for x in base if rng.random() > 0.08] + rng.sample(range(10 ** 6), rng.randrange(4))
                sets.append(np.unique(np.array(keep, np.uint64)))
        sets.sort(key=len)
        s = J.Search()
        for x in sets:
            s.add(x)
        parent = list(range(len(sets)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                    parent[find(i)] = find(j)
        for i in range(len(sets)):
            for j in range(i):
                assert (s.find(i) == s.find(j)) == (find(i) == find(j))


def test_visits_look_up_few_wide_shingles(spark):
    """Of each set that may link elsewhere enough shingles are left to find
    what it links with, and those of very many homes hardly at all."""
    rng = random.Random(3)
    hot = list(range(6))
    rows = {}                                                     # node -> (n, home, component, shingles)
    for node in range(300):
        own = [10 + rng.randrange(200) for _ in range(rng.randrange(2, 20))]
        rows[node] = (rng.choice([60, 100, 140]), node % 30, node // 3, sorted({*own, *rng.sample(hot, 4)}))
    at = spark.createDataFrame([(k, n, t, h, c) for k, (n, h, c, ts) in rows.items() for t in ts], "node long, n long, token long, home long, component long")
    kept = {}
    for r in J.rarest(at, 80).collect():
        kept.setdefault(r.node, set()).add(r.token)
    asked = {k: -(-(-(-n * 80 // 100)) // J.EACH) for k, (n, *_) in rows.items()}
    pairs = 0
    for a, (_, home, component, tokens) in rows.items():
        for b in range(a):
            if rows[b][1] != home and rows[b][2] != component and len({*tokens} & {*rows[b][3]}) >= max(asked[a], asked[b]):
                pairs += 1
                assert kept[a] & kept[b]
    assert pairs > 100
    wide = sum(len(ts & {*hot}) for ts in kept.values())
    assert wide < 0.5 * sum(len({*r[3]} & {*hot}) for r in rows.values())


def meeting(spark, rows):
    """``places`` and blocks of rows {node: (n, home, component, shingles)}."""
    at = spark.createDataFrame([(k, n, t, h, c) for k, (n, h, c, ts) in rows.items() for t in ts], "node long, n long, token long, home long, component long")
    found = J.places(at).collect()
    tasks = {}
    for r in J.tasks_of(spark.createDataFrame(found, "node long, home long, component long, n long, is_main boolean")).collect():
        tasks.setdefault((r.home, r.block), set()).add(r.node)
    return found, list(tasks.values())


@pytest.mark.parametrize("home", [10 ** 6, 1500])
def test_sets_of_a_shingle_meet(spark, monkeypatch, home):
    """Any two sets of other homes and components that share a shingle are in
    one task, whose sets are bounded."""
    monkeypatch.setattr(J, "HOME", home)
    rng = random.Random(6)
    rows = {node: (rng.choice([20, 50]), rng.randrange(12), rng.choice([0, 1, 100 + node]), rng.sample(range(40), 3)) for node in range(400)}
    _, tasks = meeting(spark, rows)
    together = {(a, b) for nodes in tasks for a in nodes for b in nodes}
    for a, (_, h, c, ts) in rows.items():
        for b in range(a):
            if rows[b][1] != h and rows[b][2] != c and {*ts} & {*rows[b][3]}:
                assert (a, b) in together
    if home == 1500:
        assert max(sum(rows[x][0] for x in nodes) for nodes in tasks) < 2 * 2 * home


def test_meetings_do_not_grow_with_the_homes(spark):
    """Five times the sets in five times the homes: a set goes to no more
    homes than it has shingles."""
    def count(n):
        rows = {node: (100, node % n, node, [0, 1, 2, 10 + node // 2]) for node in range(20 * n)}
        found, tasks = meeting(spark, rows)
        return len(found), sum(map(len, tasks))
    few, many = count(10), count(50)
    assert few[0] <= 4 * 200 and many[0] <= 6 * few[0] and many[1] <= 6 * few[1]
