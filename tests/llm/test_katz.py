"""Katz scores against a plain model that is evaluated token by token."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import katz as K
from bidscope.llm.queries import QUERIES


class Plain:
    """Two tables of counts, discounted, and a recursion."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        self.after = defaultdict(set)
        for text in texts:
            words = [*cut(text), "</s>"]
            self.one.update(words)
            for h, w in zip(["<s>", *words], words):
                self.two[h, w] += 1
                self.after[h].add(w)
        self.context = Counter()
        for (h, _), n in self.two.items():
            self.context[h] += n
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.d1, self.d2 = self.discount(self.one), self.discount(self.two)

    def discount(self, counts):
        by = np.bincount([min(c, 7) for c in counts.values()] or [0], minlength=8)
        d = K.good_turing(by[:7] if counts else np.zeros(7))
        return lambda c: c - 0.5 if c > 5 else d[c]

    def p1(self, w):
        if not self.n:
            return 1.0
        if w in self.one:
            return self.d1(self.one[w]) / self.n
        return 1 - sum(self.d1(c) for c in self.one.values()) / self.n

    def p(self, h, w):
        if not self.context[h]:
            return self.p1(w)
        if self.two[h, w]:
            return self.d2(self.two[h, w]) / self.context[h]
        left = 1 - sum(self.d2(self.two[h, x]) for x in self.after[h]) / self.context[h]
        return left / (1 - sum(self.p1(x) for x in self.after[h])) * self.p1(w)

    def score(self, text):
        words = [*cut(text), "</s>"]
        return sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *words], words))

    def base(self, text):
        return sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in [*cut(text), "</s>"])


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def check(rows, got):
    model = Plain([t for _, t, held in rows if not held])
    want = {}
    for k, t, held in rows:
        words = [*cut(t), "</s>"]
        want.setdefault((k, held), []).append((len(words), sum(w in model.one for w in words), model.n, model.base(t), model.score(t)))
    assert sum(map(len, want.values())) == len(got)
    have = {}
    for r in got:
        have.setdefault((r.doc_id, r.held_out), []).append(tuple(r)[2:])
    assert have.keys() == want.keys()
    for k in want:
        for a, b in zip(sorted(have[k]), sorted(want[k])):
            assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9, abs=1e-9)
    return model


@pytest.mark.parametrize("buckets, hot", [(1 << 30, 1024), (2000, 12)])
def test_against_plain(spark, monkeypatch, buckets, hot):
    monkeypatch.setattr(K, "BUCKET_BYTES", buckets)
    monkeypatch.setattr(K, "SLICE_BYTES", min(buckets, 1 << 20))
    monkeypatch.setattr(K, "HOT", hot)
    rng = random.Random(1)
    word = lambda: f"W{int(rng.paretovariate(0.7)) % 400}"
    rows = [(i, " ".join(word() for _ in range(rng.randrange(60))), i % 7 == 2) for i in range(200)]
    rows += [(300, None, False), (301, "", True), (302, "unknown words \n only é", True), (7, rows[7][1], False), (None, "w1 w2", False), (303, "w3 " * 3000, False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").selectExpr("*", "1 as key", "'x' as score", "2 as row").repartition(4).cache()
    model = check(rows, K.score(df, F.col("held")).collect())
    for h in ["<s>", "w1", "w3", "w77"]:
        assert sum(model.p(h, w) for w in model.one) + model.p(h, "new") == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(K.score(df, F.lit(True)).collect())
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]
    assert K.score(df.limit(0), F.lit(False)).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    check(rows, QUERIES["op5_katz"](spark, d).collect())


def test_good_turing():
    by = np.array([0, 1000, 300, 120, 60, 35, 22])
    d = K.good_turing(by)
    assert all(0 < d[r] < r for r in range(1, 6))
    rest = 6 * by[6] / by[1]
    assert d[1] == pytest.approx((2 * by[2] / by[1] - rest) / (1 - rest))
    assert K.good_turing(np.zeros(7)).tolist() == [0, 0.5, 1.5, 2.5, 3.5, 4.5]
