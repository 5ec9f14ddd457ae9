"""SpotSigs fingerprints.

A spot is a common word (the anchor) with the chain of content words that
follow it, common words skipped.  The set of a text's spots says what its
running prose is, not what menus and lists stand around it.  Sets are
compared by their Jaccard likeness; classes of set length bound it from
above, and a comparison stops as soon as the wanted likeness is out of reach.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm.columns import give_back, require
from bidscope.llm.words import ALNUM, LOWER, chain, hashes, owners, slices, split_words

CHAIN = 2                    # content words in a spot
BUCKET_BYTES = 24 << 20      # of text in a bucket of neighbouring documents, about

#: Common words of four languages, the anchors.
ANCHORS = frozenset("""
the of and to in is it that was for on are with as be at by this from or have an they which you were their but not had his
he she we has its who will more if no out so said what up about into than them can only other time new some could
de la le les et des en un une du dans est que qui pour par sur pas au plus avec ce se sont il elle on mais ou aux
der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
el los las y del se con por una su para es al lo como más o pero sus le ha este ya sí porque esta entre cuando muy sin
""".split())


def spots(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct spots of each text, as 32-bit hashes.  A text
    without a whole spot has the runs of CHAIN + 1 words instead (all its
    words, if fewer); one without words has none."""
    words = split_words(texts, LOWER, ALNUM)
    codes, starts = words.codes, words.starts
    names = [w.decode() for w in words.vocab.to_pylist()]
    common = np.fromiter((w in ANCHORS for w in names), bool, len(names))
    h = hashes(words.vocab)[codes]
    is_anchor = common[codes] if len(codes) else np.empty(0, bool)
    content = np.flatnonzero(~is_anchor)
    at = np.flatnonzero(is_anchor)
    first = np.searchsorted(content, at)
    whole = first + CHAIN <= len(content)
    at, first = at[whole], first[whole]
    text = owners(starts)
    inside = text[content[first + CHAIN - 1]] == text[at] if len(at) else np.empty(0, bool)
    at, first = at[inside], first[inside]
    found = (chain([h[at], *[h[content[first + i]] for i in range(CHAIN)]]) >> np.uint64(32)).astype(np.uint32)
    cuts = np.searchsorted(at, starts)
    out = []
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if a == b:
            own = h[starts[i]:starts[i + 1]]
            run = min(len(own), CHAIN + 1)
            here = (chain([own[k:len(own) - run + 1 + k] for k in range(run)], run) >> np.uint64(32)).astype(np.uint32) if run else np.empty(0, np.uint32)
        else:
            here = found[a:b]
        s = np.sort(here)
        out.append(s[np.append(True, s[1:] != s[:-1])] if len(s) else s)
    return out


def fingerprint(spot_set: np.ndarray) -> str:
    """The whole set: 8 hexadecimal digits for each spot, in order."""
    return spot_set.astype(">u4").tobytes().hex()


def read_fingerprint(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def length_class(n: int, least: float) -> int:
    """Sets with a likeness of ``least`` or more are in one class of length or
    in two neighbouring ones."""
    return int(math.log(n) / -math.log(least) + 1e-9) if n else -1


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets, exact if it is ``least`` or more
    and 0 otherwise; two empty sets are alike.

    The lengths bound it first; then blocks of the shorter set are probed in
    the longer one, until too many are missing."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 1.0 if not len(large) else 0.0
    if len(small) < least * len(large) - 1e-9:
        return 0.0
    total = len(small) + len(large)
    need = least * total / (1 + least) - 1e-9
    shared, step = 0, 1024
    for begin in range(0, len(small), step):
        piece = small[begin:begin + step]
        at = np.searchsorted(large, piece)
        at[at == len(large)] = 0
        shared += int((large[at] == piece).sum())
        if shared + len(small) - begin - len(piece) < need:
            return 0.0
    return shared / (total - shared)


def _neighbours(docs: DataFrame) -> DataFrame:
    """(bucket, ahead, key, text): documents in buckets of neighbouring keys.
    The first document of a bucket is once more in the one before it, as
    ``ahead``, and that of the first bucket in the last one.

    Buckets begin at the first rows of range partitions of (key, hash of
    text), about 24 MB each; three numbers a bucket reach the driver."""
    spark, kind = docs.sparkSession, docs.schema["key"].dataType.simpleString()
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = int(min(max(rows, 1), (size or 0) // BUCKET_BYTES + 1))
    docs = docs.withColumn("hash", F.xxhash64("text"))
    ranged = docs.select("key", "hash").repartitionByRange(n, F.asc_nulls_first("key"), "hash")
    first = F.min(F.struct(F.col("key").isNotNull().alias("known"), F.col("key"), F.col("hash"))).alias("first")
    cuts = sorted((r.first.known, r.first.key or 0, r.first.hash) for r in ranged.groupBy(F.spark_partition_id()).agg(first).select("first").collect())
    shared = spark.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        for batch in batches:
            rows, bucket, ahead = [], [], []
            for i, (key, own) in enumerate(zip(batch.column("key").to_pylist(), batch.column("hash").to_pylist())):
                row = (key is not None, key or 0, own)
                b = bisect_right(cuts, row) - 1
                rows.append(i)
                bucket.append(b)
                ahead.append(0)
                if cuts[b] == row:
                    rows.append(i)
                    bucket.append((b - 1) % len(cuts))
                    ahead.append(1)
            took = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(ahead, pa.int32()), *took.columns], ["bucket", "ahead", *took.schema.names])

    return (docs.mapInArrow(place, f"bucket int, ahead int, key {kind}, text string, hash long")
            .repartition(n, "bucket").sortWithinPartitions("bucket", "ahead", F.asc_nulls_first("key"), "hash", "text").drop("hash"))


def edited(text: str, after: str) -> str:
    """The last half of the code points replaced by the first of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = 2000) -> DataFrame:
    """For each row of ``docs``: its key, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``.

    The next document is the one with the next key (an integer), after the
    last the first; null keys come before all others, rows with one key in
    the order of their texts' hashes.  Null texts are empty.  Every text is read
    whole.  One shuffle of the table, in buckets of bounded size."""
    require(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    rows = _neighbours(docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for begin in range(0, batch.num_rows, bucket_rows):
                piece = pa.Table.from_batches([batch.slice(begin, bucket_rows)])
                held = piece if held is None else pa.concat_tables([held, piece])
                if held.num_rows > 1:
                    yield _compare(held)
                    held = held.slice(held.num_rows - 1)
        give_back()

    return rows.mapInArrow(run, f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double").withColumnRenamed("key", key)


def _compare(rows: pa.Table) -> pa.RecordBatch:
    """Of all rows but the last, which is there to be the next one."""
    texts = rows.column("text").to_pylist()
    own = np.flatnonzero(rows.column("ahead").to_numpy()[:-1] == 0).tolist()
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    sets = spots(pa.array(texts, pa.large_string()))
    changed_sets = spots(pa.array(changed, pa.large_string()))
    return pa.RecordBatch.from_arrays([
        rows.column("key").combine_chunks().take(pa.array(own, pa.int64())),
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([fingerprint(sets[i]) for i in own], pa.string()),
        pa.array(list(map(fingerprint, changed_sets)), pa.string()),
        pa.array([likeness(sets[i], s) for i, s in zip(own, changed_sets)], pa.float64()),
        pa.array([likeness(sets[i], sets[i + 1]) for i in own], pa.float64()),
    ], ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


class Lengths:
    """Sets in classes of length, each with inverted lists of first spots.

    Sets with a likeness of ``least`` share one of the first n - least * n + 1
    spots of each, in the order of the spots' hashes, and lie in one class or
    in two neighbouring ones."""

    def __init__(self, sets: list[np.ndarray], least: float):
        self.sets, self.least = sets, least
        self.classes: dict[int, dict[int, list[int]]] = {}
        for i, s in enumerate(sets):
            lists = self.classes.setdefault(length_class(len(s), least), {})
            for spot in self._first(s):
                lists.setdefault(spot, []).append(i)

    def _first(self, s: np.ndarray) -> list[int]:
        return s[:len(s) - math.ceil(self.least * len(s) - 1e-9) + 1].tolist()

    def near(self, s: np.ndarray) -> list[tuple[int, float]]:
        """Sets with a likeness of ``least`` or more, and the likeness."""
        own, out = length_class(len(s), self.least), []
        first = self._first(s)
        for c in (own - 1, own, own + 1):
            lists = self.classes.get(c)
            if lists:
                met = {i for spot in first for i in lists.get(spot, ())}
                out += [(i, like) for i in sorted(met) if (like := likeness(s, self.sets[i], self.least)) > 0]
        return out


def search(docs: DataFrame, queries: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text",
           block_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(key, query, likeness) of all texts of ``docs`` whose fingerprints are
    like those of the stated ``queries`` by ``least`` (over 0) or more.

    Queries come in blocks of bounded size, each sent to the tasks, which read
    all of ``docs``.  Texts without spots are like nothing.  Repeated rows
    count each."""
    require(docs, key, text)
    require(queries, key, text)
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    schema, found = f"`{key}` {kind}, query {kind}, likeness double", None
    for block in _query_blocks(queries.select(key, text), block_bytes):
        names = pa.array([k for k, _ in block])
        index = spark.sparkContext.broadcast((names, Lengths(spots(pa.array([t or "" for _, t in block], pa.large_string())), least)))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            names, lengths = index.value
            for batch in batches:
                for part in slices(batch, text):
                    hits = [(row, i, like) for row, s in enumerate(spots(part.column(text))) if len(s) for i, like in lengths.near(s)]
                    rows, which, likes = zip(*hits) if hits else ((), (), ())
                    yield pa.RecordBatch.from_arrays([part.column(key).take(pa.array(rows, pa.int64())), names.take(pa.array(which, pa.int64())).cast(part.column(key).type),
                                                      pa.array(likes, pa.float64())], [key, "query", "likeness"])

        hits = docs.select(key, text).mapInArrow(run, schema)
        found = hits if found is None else found.union(hits)
    return spark.createDataFrame([], schema) if found is None else found


def _query_blocks(queries: DataFrame, most: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in queries.toLocalIterator():
        if block and size + len(row[1] or "") > most:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1] or "")
    if block:
        yield block
