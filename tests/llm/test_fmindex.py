"""FM-index search against brute force."""
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from bidscope.llm import fmindex as M


def brute(words, items, window):
    """(hit word numbers, items) of one document's words."""
    hit, names = set(), set()
    for name, v in items:
        for x in [v[a:a + window] for a in range(max(1, len(v) - window + 1))] if v else []:
            for a in range(len(words) - len(x) + 1):
                if words[a:a + len(x)] == x:
                    hit |= set(range(a, a + len(x)))
                    names.add(name)
    return hit, sorted(names)


@pytest.mark.parametrize("seed", range(40))
def test_shard_search(seed):
    rng = random.Random(seed)
    docs = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 12))]
    docs += docs[:2] * (seed % 3 == 0)
    items = [(str(i), " ".join(rng.choice("abcde") for _ in range(rng.randrange(6)))) for i in range(6)]
    index = M.Index.load(M.Index.build(pa.array(docs)).dump())
    got = {d: (set(x for a, b in s for x in range(a, b)), names) for d, s, names in M.occurrences(index, M.phrases_of(items, 3))}
    want = {d: brute(t.split(), [(k, v.split()) for k, v in items], 3) for d, t in enumerate(docs)}
    assert got == {d: x for d, x in want.items() if x[0]}


def test_suffix_order():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        text = np.append(rng.integers(1, 4, n - 1), 0)
        assert M.suffix_order(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


@pytest.fixture(scope="module")
def tables(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    phrase = "one two three four five six seven eight nine ten"
    docs = [(1, f"x {phrase.upper()} eleven, y"), (2, None), (3, ""), (4, "--- !!"), (5, long), (6, "one two three"), (6, "one two three"),
            (None, f"{phrase}\n{phrase}"), (7, "a b c d e f g h i é")]
    items = [(10, phrase + " eleven"), (2, "Two  three"), (3, None), (4, ""), (None, "w29998 w29999"), (2, "é")]
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_hit"),
            spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as spans"), docs, items)


@pytest.mark.parametrize("block", [1, 1_000_000])
def test_contamination(spark, tables, tmp_path, block):
    import re
    docs, items, doc_rows, item_rows = tables
    M.build_index(docs).write.parquet(str(tmp_path / "index"))
    got = M.contamination(spark.read.parquet(str(tmp_path / "index")), items, block_words=block).collect()
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for key, text in doc_rows:
        hit, names = brute(cut(text), [("" if k is None else str(k), cut(t)) for k, t in item_rows], 10)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        want.append((key, len(cut(text)), len(hit), len(names), sha, bool(hit)))
    assert sorted(map(str, (tuple(r)[:-1] for r in got))) == sorted(map(str, want))


def test_empty_tables(spark, tables, tmp_path):
    docs, items, _, _ = tables
    M.build_index(docs).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    assert not any(r.contaminated for r in M.contamination(index, items.limit(0)).collect())
    M.build_index(docs.limit(0)).write.parquet(str(tmp_path / "none"))
    assert M.contamination(spark.read.parquet(str(tmp_path / "none")), items).count() == 0


def test_cut_spans():
    assert M.cut_spans("A, b c! d é.", [(1, 3)]) == "A, ! d é."
    assert M.cut_spans("a b", [(0, 2)]) == ""
