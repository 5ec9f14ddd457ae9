"""Prefix BPE against the tokenizer library, and its own invariants."""
import base64
import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
import tiktoken

from bidscope.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = list("ab e  \n\t'sllve1²３é漢 　\x1c\x85!?-_")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n, longest=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_ids_equal_the_librarys(library):
    e = bpe.encoder(PATH, PATTERN)
    texts = odd_texts(3000) + ["<|endoftext|> it's  we'll\n\n x", "", " ", "a" * 5000]
    assert e.encode_all(texts) == [library.encode_ordinary(t) for t in texts]
    assert all(e.decode(e.encode(t)) == t.encode() for t in texts)


def test_every_prefix_append_and_edit():
    v, rng = bpe.encoder(PATH, PATTERN).vocabulary, random.Random(5)
    words = ["unbelievable", "tokenization", "thnterble", "naïveté", "aaaaaaaaaaaa", "12341234"]
    for word in words:
        raw = word.encode()
        p = bpe.Prefixes(v, raw)
        for n in range(len(raw) + 1):
            assert p.ids(n) == bpe.Prefixes(v, raw[:n]).ids()
        grown = bpe.Prefixes(v, raw[:3]).append(raw[3:])
        assert grown.last == p.last
    for _ in range(500):
        raw, new = rng.choice(words).encode() * 3, rng.choice(words).encode()[:rng.randrange(5)]
        a = rng.randrange(len(raw) + 1)
        b = rng.randrange(a, len(raw) + 1)
        p = bpe.Prefixes(v, raw)
        p.edit(a, b, new)
        assert (p.piece, p.last) == (raw[:a] + new + raw[b:], bpe.Prefixes(v, raw[:a] + new + raw[b:]).last)


def test_table_edge_cases(spark, library):
    rows = [(1, None, 7), (2, "", 7), (3, "it's a  test\n\nx", 7), (3, "it's a  test\n\nx", 7), (None, "word " * 40000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = bpe.encode_documents(df, PATH, PATTERN)
    assert [f.dataType.simpleString() for f in out.schema if f.name == "n_tokens"] == ["bigint"]
    got = sorted(out.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    for r, (_, text, _) in zip(got, rows):
        ids = library.encode_ordinary(text or "")
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    back = bpe.decode_documents(out, PATH, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe.encode_documents(df.limit(0), PATH, PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_documents(df, PATH, PATTERN, text="absent")


def test_a_long_piece_takes_memory_by_its_length():
    e = bpe.encoder(PATH, PATTERN)
    for piece in ("x" * 20_000, "=" * 200_000):
        tracemalloc.start()
        ids = e.encode(piece)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert ids == bpe.Prefixes(e.vocabulary, piece.encode()).ids() and e.decode(ids) == piece.encode()
        assert peak < 100 * len(piece) + 2_000_000
