"""The pipeline against brute force, stage by stage."""
import base64
import re

import public_tokenizers
import tiktoken

import corpus_pipeline as C
from bidscope.llm import quality as Q
from test_fmindex import brute as brute_hits
from test_jaccard import brute as brute_groups

D = "/root/testdata/sf0.001"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}

    accepted = {r.doc_id for r in Q.classify(spark, docs, spark.read.parquet(f"{D}/labels.parquet")).collect() if r.predicted}
    one = C.keep_quality(spark, docs, D)
    assert one.schema == docs.schema and {r.doc_id for r in one.collect()} == accepted and 0 < len(accepted) < len(texts)

    rows = [(k, texts[k]) for k in sorted(accepted)]
    least = {re.match(r"\((\d+), \d+, (\d+)\)", x)[2] for x in brute_groups(rows)}
    one = spark.createDataFrame(docs.where(docs.doc_id.isin(*accepted)).collect(), docs.schema)
    two = C.keep_one_of_each_group(spark, one, D)
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == set(map(int, least))

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    items = [(str(r.item_id), cut(r.text)) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    clean = {k for k in map(int, least) if not brute_hits(cut(texts[k]), items, 10)[0]}
    two = spark.createDataFrame(docs.where(docs.doc_id.isin(*map(int, least))).collect(), docs.schema)
    three = C.drop_benchmark(spark, two, D)
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} == clean and len(clean) < len(least)

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = C.run(spark, D).collect()
    assert {r.doc_id for r in got} == clean
    assert all(r.ids == library.encode_ordinary(texts[r.doc_id]) for r in got)


def test_edges(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c d e f", "en", None, 11), (3, "a b c d e f", None, "s", 11), (3, "a b c d e f", None, "s", 11)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{D}/documents.parquet").schema)
    kept = C.keep_one_of_each_group(spark, docs, D).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3"]
    assert C.drop_benchmark(spark, docs, D).count() == 5
    for _, apply in C.STAGES:
        assert apply(spark, docs.limit(0), D).count() == 0
    long = spark.createDataFrame([(10, "long text " * 200_000, "en", "s", 0), (11, "one two three four five six seven", "en", "s", 0)], docs.schema)
    odd = docs.unionByName(long).selectExpr("*", "1 as _own", "2 as _other", "3 as _hit", "4 as __own", "5 as _score", "6 as predicted")
    for _, apply in C.STAGES[1:3]:
        kept = apply(spark, odd, D)
        assert kept.columns == odd.columns and {(r._own, r._other, r._hit) for r in kept.collect()} == {(1, 2, 3)}
    assert C.keep_quality(spark, odd, D).columns == odd.columns
    assert {r.doc_id: r.n_tokens for r in C.encode(spark, odd, D).collect()}[10] > 200_000
    clash = docs.withColumn("score", docs.n_chars)
    assert C.keep_quality(spark, clash, D).schema["score"].dataType.simpleString() == "bigint"


def test_doc_ids_that_repeat_or_are_null(spark):
    near = [" ".join(f"w{i}" for i in range(100)) + f" end{k}" for k in range(4)]
    own = [" ".join(f"v{k}x{i}" for i in range(20)) for k in range(6)]
    rows = [(1, near[0], "en", "s", 0), (None, near[1], "en", "s", 0), (None, own[0], "en", "s", 0), (None, own[1], "en", "s", 0),
            (7, near[2], "en", "s", 0), (7, own[2], "en", "s", 0),                      # a near copy's id on a clean text
            (None, "a b c d e f", "en", "s", 0), (None, "A b c d e f", "en", "s", 0),   # one group without ids
            (8, own[3], "en", "s", 0), (8, own[3] + " ", "en", "s", 0), (8, own[3], "en", None, 0), (8, own[3], None, "en", 0),   # one id
            (9, "", "en", "s", 0), (9, "", "fr", "s", 0), (9, None, "fr", "s", 0)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{D}/documents.parquet").schema)
    kept = [(r.doc_id, (r.text or "").lower().strip()) for r in C.keep_one_of_each_group(spark, docs, D).collect()]
    want = [(1, near[0]), (None, own[0]), (None, own[1]), (7, own[2]), (None, "a b c d e f"), (8, own[3]), (9, ""), (9, ""), (9, "")]
    assert sorted(map(str, kept)) == sorted(map(str, want))


def test_index_is_written_in_small_row_groups(spark, monkeypatch):
    """A shard's index is a megabyte: neither a writer nor a reader holds all of a task."""
    import glob
    import random

    import pyarrow.parquet as pq
    rng, found, run = random.Random(2), [], C.stage

    def kept(df, name, **options):
        out = run(df, name, **options)
        found.extend(out.inputFiles() if name == "fm-index" else [])
        return out
    monkeypatch.setattr(C, "stage", kept)
    rows = [(k, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60_000)), "en", "s", 0) for k in range(30)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{D}/documents.parquet").schema).coalesce(1)
    assert C.drop_benchmark(spark, docs, D).count() == 30
    groups = [g for f in found for path in glob.glob(f.removeprefix("file://").removeprefix("file:")) for m in [pq.ParquetFile(path).metadata] for g in map(m.row_group, range(m.num_row_groups))]
    assert len(groups) > 3 and max(g.total_byte_size for g in groups) < 8 << 20
