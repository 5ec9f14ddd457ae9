"""Fingerprints against a plain version, text by text."""
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from bidscope.llm import spotsigs as S


def plain(text):
    """Spots as strings of words."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    out = set()
    for i, w in enumerate(words):
        if w in S.ANCHORS:
            tail = [x for x in words[i + 1:] if x not in S.ANCHORS][:S.CHAIN]
            if len(tail) == S.CHAIN:
                out.add((w, *tail))
    if not out:
        run = min(len(words), S.CHAIN + 1)
        out = {tuple(words[i:i + run]) for i in range(len(words) - run + 1)} if run else set()
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["The cat of the old house sat on a red mat and slept", "", "of the", "table | one | two | three | four", "é",
         "THE cat of the old house sat on a red mat, and woke!", " \n", "for you a b c d to e f g"]


@pytest.mark.parametrize("bucket", [S.BUCKET_BYTES, 64])
def test_against_plain(spark, monkeypatch, bucket):
    monkeypatch.setattr(S, "BUCKET_BYTES", bucket)
    rows = [(10 * i, t) for i, t in enumerate(TEXTS)] + [(5, None), (7, "the " * 3 + "long text goes here " * 9000), (100, TEXTS[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as bucket", "3 as ahead").repartition(3)
    got = {r.doc_id: r for r in S.fingerprints(df).collect()}
    rows = sorted((k, t or "") for k, t in rows)
    assert len(got) == len(rows)
    for (k, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert r.near_edited == pytest.approx(jaccard(plain(t), plain(new)))
        assert r.near_next == pytest.approx(jaccard(plain(t), plain(after)))
        assert len(r.fingerprint) == 8 * len(plain(t)) and len(r.edited_fingerprint) == 8 * len(plain(new))
    assert got[0].fingerprint == got[100].fingerprint


def test_repeated_and_null_keys(spark):
    rows = [(1, "of a b"), (1, "of a b"), (1, "of a c"), (None, "to x y"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.fingerprints(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 6, 6, 6, 6]
    assert S.fingerprints(df.limit(0)).count() == 0
    assert S.fingerprints(df.where("doc_id = 1").limit(1)).first().near_next == 1.0


def test_no_row_is_lost(spark, monkeypatch):
    """Keys beyond 2 ** 53 next to each other, nulls among them, and one key
    with many texts, in buckets of few rows."""
    monkeypatch.setattr(S, "BUCKET_BYTES", 40)
    rows = [(2 ** 60 + i, f"the w{i} x{i}") for i in range(60)] + [(None, f"of n{i} m{i}") for i in range(9)] + [(7, f"to a{i} b") for i in range(30)]
    rows += [(2 ** 60 + 3, "the w3 x3")] * 2
    got = S.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(k), len(t)) for k, t in rows)
    known = {k: t for k, t in rows}
    for r in got:
        if r.doc_id is not None and r.doc_id >= 2 ** 60 + 4:
            new = S.edited(known[r.doc_id], known.get(r.doc_id + 1, ""))
            assert r.doc_id == 2 ** 60 + 59 or r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()


def test_likeness_and_classes():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 50))).astype(np.uint32) for _ in "ab")
        exact = jaccard(set(a.tolist()), set(b.tolist()))
        assert S.likeness(a, b) == pytest.approx(exact)
        for least in (0.2, 0.5, 0.8):
            assert S.likeness(a, b, least) == pytest.approx(exact if exact >= least else 0)
            if exact >= least and len(a) and len(b):
                assert abs(S.length_class(len(a), least) - S.length_class(len(b), least)) <= 1
        assert (S.read_fingerprint(S.fingerprint(a)) == a).all()
    assert S.spots(pa.array([], pa.string())) == []


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_search_against_all_pairs(spark, block):
    import random
    rng = random.Random(3)
    words = ["the", "of", "and"] + [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(rng.randrange(5, 150))] for _ in range(12)]
    texts = [" ".join(b) for b in base]
    texts += [" ".join(rng.choice(words) if rng.random() < 0.02 else w for w in b) for b in base for _ in range(6)] + [texts[0], "", None, "---"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = S.search(df, df.where("doc_id % 5 = 0"), 0.6, block_bytes=block).collect()
    want = {}
    for a, t in rows:
        for b, u in rows:
            if b % 5 == 0 and plain(t or "") and plain(u or "") and jaccard(plain(t or ""), plain(u or "")) >= 0.6 - 1e-12:
                want[a, b] = jaccard(plain(t or ""), plain(u or ""))
    assert {(r.doc_id, r.query) for r in got} == set(want) and len(got) == len(want) > 40
    assert all(r.likeness == pytest.approx(want[r.doc_id, r.query]) for r in got)
    assert S.search(df, df.limit(0)).count() == 0 and S.search(df.limit(0), df).count() == 0
