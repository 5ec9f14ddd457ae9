"""Katz backoff language model over words, order two.

P(w | h) is the Good-Turing discounted count of h w over the count of h if the
pair was seen; else the backoff weight of h times P(w).  P(w) is the
discounted count of w over all tokens, and what the discounts leave goes to
unknown words.  The backoff weight shares what the discounts of h's pairs
leave among all words that never followed h, so every context sums to one.

Counts up to CUT are discounted by Good and Turing, greater ones by a half, so
that every context keeps something for unseen words.

The pairs of all texts meet once, in buckets by the word (those of a hot word
by its context too).  A bucket knows the counts of its words and pairs: it
tells every token's text both, tells each context what its pairs weigh, and
passes on tokens whose pair is unseen.  Those meet the contexts' weights in
buckets by context, where the recursion to the shorter history ends, and what
it gives goes back to the texts.  What goes between buckets are compressed
Arrow tables of whole columns, a few bytes for each token.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bidscope.llm.columns import require
from bidscope.llm.words import hashes, mix, slices, split_words
from bidscope.session import scratch_path

CUT = 5                       # counts up to it are discounted by Good and Turing
HALF = 0.5                    # of greater counts
HOT = 1024                    # a word with one of so many tokens, or more, is hot
BUCKET_BYTES = 20 << 20       # of text whose tokens meet in a bucket, about
SLICE_BYTES = 24 << 20        # of text that a task sends in one go
ROW_BITS = 32                 # of a row's number in its task
FOLDS, HELD_OUT = 7, 2

#: Not words: they hold a space.
START, END = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" start", b" end"))
BLOCK = "bucket int, kind int, first long, body binary"
#: Kinds of blocks: tokens to their words, texts, counts to texts, pairs and tokens to contexts, numbers of pairs, and
#: what unseen pairs add to texts.
TOKENS, TEXTS, COUNTS, SEEN, UNSEEN, STATS, BACK = range(7)


def pack(**columns: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for k, v in columns.items()})
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(body: pa.Scalar) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(body.as_buffer()).read_all()
    return {n: table.column(n).chunk(0).values.to_numpy(zero_copy_only=False) for n in table.column_names}


def gaps(x: np.ndarray) -> np.ndarray:
    """Ascending values as differences, which compress."""
    return np.diff(x, prepend=np.uint64(0))


def narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint16 if not len(x) or x.max() < 1 << 16 else np.uint32)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys starts."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    return ((mix(x) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class Unigrams(NamedTuple):
    tokens: int
    types: int
    documents: int            # learned from
    discounted: np.ndarray    # of counts 0 (all unknown words together) to CUT
    hot: np.ndarray           # hashes, ascending
    hot_counts: np.ndarray

    def probability(self, count: np.ndarray) -> np.ndarray:
        """Of a word with this count; of all unknown words for 0."""
        return np.where(count > CUT, count - HALF, self.discounted[np.minimum(count, CUT)]) / max(self.tokens, 1)


def good_turing(n: np.ndarray) -> np.ndarray:
    """Discounted counts 0 to CUT from the numbers n[r] of types with a count
    of r (to CUT + 1).  Where these are too few for a discount between none
    and all, a half is taken off."""
    out = np.maximum(np.arange(CUT + 1.0) - HALF, 0)
    rest = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        if n[r] and rest < 1:
            share = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest)
            if 0 < share < 1:
                out[r] = r * share
    return out


def _sequences(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: distinct hashes, ascending, and for each token its own and
    its context's index in them, and its text."""
    words = split_words(part.column("text"))
    h = np.concatenate([hashes(words.vocab), [START, END]]).astype(np.uint64)
    distinct, place = np.unique(h, return_inverse=True)
    n_texts, n = part.num_rows, len(words.codes)
    starts = words.starts + np.arange(n_texts + 1)
    text = np.repeat(np.arange(n_texts, dtype=np.int32), np.diff(starts))
    last = np.zeros(n + n_texts, bool)
    last[starts[1:] - 1] = True
    word = np.empty(n + n_texts, np.int32)
    word[~last] = place[:-2][words.codes]
    word[last] = place[-1]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[starts[:-1]] = place[-2]
    return distinct, word, context, text


def unigrams(docs: DataFrame, n_buckets: int, path: str) -> Unigrams:
    """Count the words of texts that are not held out, write the counts to
    ``path`` in buckets, and return what all texts share: totals, numbers of
    types by count, and the hot words (at most HOT)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                learned = ~part.column("held_out").to_numpy(zero_copy_only=False)
                distinct, word, _, text = _sequences(part)
                n = np.bincount(word[learned[text]], minlength=len(distinct))
                h, n = distinct[n > 0], n[n > 0]
                b = _bucket(h, n_buckets)
                by = np.argsort(b, kind="stable")
                h, n, b = h[by], n[by], b[by]
                at = runs(b)
                yield _blocks(b[at], TOKENS, 0, [pack(h=gaps(x), n=narrow(y)) for x, y in zip(np.split(h, at[1:]), np.split(n, at[1:]))] if len(h) else [])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, got = 0, []
        for batch in batches:
            bucket = batch.column("bucket")[0].as_py()
            got += [unpack(x) for x in batch.column("body")]
        h = np.concatenate([np.cumsum(x["h"], dtype=np.uint64) for x in got])
        n = np.concatenate([x["n"].astype(np.int64) for x in got])
        by = np.argsort(h)
        h, n = h[by], n[by]
        at = runs(h)
        h, n = h[at], np.add.reduceat(n, at)
        most = np.argsort(-n, kind="stable")[:HOT]
        yield pa.RecordBatch.from_arrays([
            pa.array([bucket], pa.int32()), pa.array([pack(h=gaps(h), n=n)], pa.binary()), pa.array([int(n.sum())], pa.int64()), pa.array([len(h)], pa.int64()),
            pa.array([np.bincount(np.minimum(n, CUT + 2), minlength=CUT + 3)[:CUT + 2].tolist()], pa.list_(pa.int64())),
            pa.array([h[most].view(np.int64).tolist()], pa.list_(pa.int64())), pa.array([n[most].tolist()], pa.list_(pa.int64()))],
            ["bucket", "body", "tokens", "types", "by_count", "words", "counts"])

    (docs.mapInArrow(count, BLOCK).groupBy("bucket").applyInArrow(
        add, "bucket int, body binary, tokens long, types long, by_count array<long>, words array<long>, counts array<long>")
     .write.mode("overwrite").parquet(path))
    stored = docs.sparkSession.read.parquet(path)
    at = lambda r: F.coalesce(F.sum(F.col("by_count")[r]), F.lit(0))
    tokens, types, *by_count = stored.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0)), *[at(r) for r in range(CUT + 2)]).first()
    hot = (stored.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).where(F.col("x.counts") * HOT >= tokens)
           .select("x.words", "x.counts").collect())              # at most HOT rows
    hot = sorted((np.uint64(w & (1 << 64) - 1), n) for w, n in hot)
    counts = good_turing(np.array(by_count))
    by_rank = np.array(by_count[1:CUT + 1]) @ counts[1:]
    more = tokens - np.array(by_count[1:CUT + 1]) @ np.arange(1, CUT + 1) - HALF * (types - sum(by_count[1:CUT + 1]))
    counts[0] = tokens - by_rank - more if tokens else 1
    n_learned = docs.where("not held_out").count()
    return Unigrams(tokens, types, n_learned, counts, np.array([h for h, _ in hot], np.uint64), np.array([n for _, n in hot], np.int64))


def _blocks(buckets, kind: int, first: int, bodies: list[bytes]) -> pa.RecordBatch:
    n = len(bodies)
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(buckets)[:n], pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([first] * n, pa.int64()),
                                       pa.array(bodies, pa.binary())], ["bucket", "kind", "first", "body"])


def _find(sorted_hashes: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index of h in sorted_hashes, -1 if it is not there."""
    if not len(sorted_hashes):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == h, at, -1)


def _order(bucket: np.ndarray, word: np.ndarray, context: np.ndarray, size: int) -> np.ndarray:
    bits = size.bit_length()
    if 2 * bits + int(bucket.max(initial=0)).bit_length() > 62:
        return np.lexsort((context, word, bucket))
    key = bucket.astype(np.int64) << bits
    key |= word
    key <<= bits
    key |= context
    return np.argsort(key)


def _send(n_buckets: int, hot: np.ndarray) -> Callable:
    """Tokens of a slice to their buckets: for each, its word, context and
    text.  The texts themselves go along to where they are scored: the group
    of their task, with numbers above those of the buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        row = task << ROW_BITS
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                learned = ~part.column("held_out").to_numpy(zero_copy_only=False)
                distinct, word, context, text = _sequences(part)
                is_hot = (_find(hot, distinct) >= 0)[word]
                bucket = _bucket(distinct, n_buckets).astype(np.int32)[word]
                bucket[is_hot] = _bucket(distinct[word[is_hot]] ^ mix(distinct[context[is_hot]]), n_buckets)
                n = np.bincount(text, minlength=part.num_rows)
                by = _order(bucket, word, context, len(distinct))
                word, context, text, bucket = word[by], context[by], text[by], bucket[by]
                del by
                cuts = np.append(runs(bucket), len(bucket))
                bodies = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    at = runs(word[a:b])
                    seen, index = _numbered(context[a:b], len(distinct))
                    texts, own = _numbered(text[a:b], part.num_rows)
                    bodies.append(pack(w=gaps(distinct[word[a:b][at]]), run=narrow(np.diff(np.append(at, b - a))), h=gaps(distinct[seen]),
                                       at=narrow(index), text=narrow(own), texts=narrow(texts), learned=learned[texts]))
                yield _blocks(bucket[cuts[:-1]], TOKENS, row, bodies)
                table = pa.table({"key": part.column("key"), "held_out": part.column("held_out"), "n": n})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as writer:
                    writer.write_table(table)
                yield _blocks([n_buckets + task], TEXTS, row, [sink.getvalue().to_pybytes()])
                row += part.num_rows
    return run


def _numbered(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of x, which are below size, and the number of each."""
    here = np.zeros(size, bool)
    here[x] = True
    return np.flatnonzero(here), (np.cumsum(here, dtype=np.int32) - 1)[x]


def _ranked(found: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All hashes of several ascending arrays, and each one's ranks in them."""
    every = np.unique(np.concatenate([np.empty(0, np.uint64), *found]))
    return every, [np.searchsorted(every, x) for x in found]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Scalar]]:
    for batch in batches:
        yield from zip(batch.column("kind").to_pylist(), batch.column("first").to_pylist(), batch.column("body"))


def _count(model: Unigrams, n_buckets: int) -> Callable:
    """In the bucket of some words: count their pairs in texts that are
    learned from, and tell everyone what they ask for.  A hot context asks in
    every bucket by context, and its tokens go to that of their text."""
    everywhere = lambda h: (_find(model.hot, h) >= 0) | (h == START)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key[0].as_py() >= n_buckets:                       # texts, on their way
            for kind, first, body in _read(batches):
                yield _blocks([key[0].as_py()], kind, first, [body.as_py()])
            return
        got, rows, base = [], [np.empty(0, np.int64)], 0
        for _, first, body in _read(batches):
            x = unpack(body)
            rows.append(first + x["texts"].astype(np.int64))
            x["learned"] = x["learned"][x["text"]]
            x["text"] = x["text"] + np.int32(base)
            base += len(x["texts"])
            got.append(x)
        words, w_ranks = _ranked([np.cumsum(x["w"], dtype=np.uint64) for x in got])
        contexts, h_ranks = _ranked([np.cumsum(x["h"], dtype=np.uint64) for x in got])
        pairs = np.concatenate([np.repeat(w, x["run"]) << 32 | h[x["at"]] for x, w, h in zip(got, w_ranks, h_ranks)])
        text = np.concatenate([x["text"] for x in got])
        learned = np.concatenate([x["learned"] for x in got])
        del got
        rows = np.concatenate(rows)
        by = np.argsort(pairs)
        pairs, text, learned = pairs[by], text[by], learned[by]
        del by
        at, word_at = runs(pairs), runs(pairs >> 32)
        size = np.diff(np.append(at, len(pairs)))
        pair_count = np.add.reduceat(learned, at, dtype=np.int64)
        count = np.add.reduceat(learned, word_at, dtype=np.int64)
        if len(model.hot):
            hot = _find(model.hot, words[pairs[word_at] >> 32])
            count = np.where(hot >= 0, model.hot_counts[hot], count)
        del learned
        count = np.repeat(count, np.diff(np.append(np.searchsorted(at, word_at), len(at))))      # of each pair's word
        context = contexts[pairs[at] & (1 << 32) - 1]
        del pairs

        yield _blocks([-1], STATS, 0, [pack(n=np.bincount(np.minimum(pair_count, CUT + 2), minlength=CUT + 3)[:CUT + 2])])
        yield from _to_contexts(context, pair_count, count)
        unseen = np.flatnonzero(np.repeat(pair_count == 0, size))
        pair = np.searchsorted(at, unseen, "right") - 1
        yield from _unseen(context[pair], rows[text[unseen]], count[pair])

        by = np.argsort(text, kind="stable")                  # texts of one task lie together
        pair = np.repeat(np.arange(len(at), dtype=np.int32), size)[by]
        text = text[by]
        task = rows >> ROW_BITS
        cuts = np.append(runs(task), len(task))
        ends = np.searchsorted(text, cuts)
        for t, u, a, b in zip(cuts[:-1], cuts[1:], ends[:-1], ends[1:]):
            first, own = int(rows[t]), rows[t:u]
            step = np.diff(own[text[a:b] - t], prepend=first)
            yield _blocks([n_buckets + int(task[t])], COUNTS, first, [pack(step=step if step.min() < 0 else narrow(step), n=narrow(count[pair[a:b]]), pair=narrow(pair_count[pair[a:b]]))])

    def _to_contexts(h: np.ndarray, c: np.ndarray, word_count: np.ndarray) -> Iterator[pa.RecordBatch]:
        seen = c > 0
        h, c, share = h[seen], c[seen], model.probability(word_count[seen])
        by = np.argsort(h)
        h, c, share = h[by], c[by], share[by]
        at = runs(h)
        add = lambda x: np.add.reduceat(x, at) if len(at) else x
        pairs = [add((c == r).astype(np.int64)) for r in range(1, CUT + 1)] + [add((c > CUT).astype(np.int64))]
        h, share = h[at], add(share)
        common = everywhere(h)
        own = np.where(common, -1, _bucket(h, n_buckets))
        by = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[by], np.arange(-1, n_buckets + 1))
        for q in range(n_buckets):
            x = np.sort(np.concatenate([by[:cuts[1]], by[cuts[q + 1]:cuts[q + 2]]]))
            if len(x):
                yield _blocks([q], SEEN, 0, [pack(h=gaps(h[x]), share=share[x], **{f"p{i}": narrow(p[x]) for i, p in enumerate(pairs)})])

    def _unseen(h: np.ndarray, row: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = np.where(everywhere(h), _bucket(row.astype(np.uint64), n_buckets), _bucket(h, n_buckets))
        by = np.lexsort((h, own))
        h, row, count, own = h[by], row[by], count[by], own[by]
        cuts = np.append(runs(own), len(own))
        for a, z in zip(cuts[:-1], cuts[1:]):
            yield _blocks([own[a]], UNSEEN, 0, [pack(h=gaps(h[a:z]), row=row[a:z], n=narrow(count[a:z]))])

    return run


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of pairs by count that the buckets have told."""
    for kind, _, body in _read(batches):
        if kind == STATS:
            yield pa.RecordBatch.from_arrays([pa.array([unpack(body)["n"].tolist()], pa.list_(pa.int64()))], ["n"])


def _discounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([good_turing(np.array(n)).tolist() for n in batch.column("n").to_pylist()], pa.list_(pa.float64()))], ["discounted"])


def _back_off(model: Unigrams, n_buckets: int) -> Callable:
    """Of each text, what its unseen pairs here add to its score: the weight
    of the context (and its count, which the text's sums take off) and the
    probability of the word alone.  After an unknown context that is all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = {"h": np.empty(0, np.uint64), "share": np.empty(0), **{f"p{i}": np.empty(0) for i in range(CUT + 1)}}
        contexts, tokens, discounted = [none], [], None
        for batch in batches:
            discounted = np.array(batch.column("discounted")[0].as_py())
            for kind, _, body in _read([batch]):
                if kind not in (SEEN, UNSEEN):
                    continue
                x = unpack(body)
                x["h"] = np.cumsum(x["h"], dtype=np.uint64)
                (tokens if kind == UNSEEN else contexts).append(x)
        if not tokens:
            return
        h = np.concatenate([x["h"] for x in contexts])
        by = np.argsort(h)
        h = h[by]
        at = runs(h)
        total = lambda name: np.add.reduceat(np.concatenate([x[name].astype(np.float64) for x in contexts])[by], at) if len(at) else np.empty(0)
        pairs = [total(f"p{i}") for i in range(CUT + 1)]
        taken = sum(p * (r + 1 - discounted[r + 1]) for r, p in enumerate(pairs[:CUT])) + pairs[CUT] * HALF
        weight = np.append(np.log10(taken / (1 - total("share"))), 0)     # times the context's count; the last is for unknown ones
        of, row, n = (np.concatenate([x[name] for x in tokens]) for name in ("h", "row", "n"))
        back = np.log10(model.probability(n.astype(np.int64))) + weight[_find(h[at], of)]
        rows, index = np.unique(row, return_inverse=True)
        back = np.bincount(index, back, len(rows))
        task = rows >> ROW_BITS
        cuts = np.append(runs(task), len(task))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield _blocks([n_buckets + int(task[a])], BACK, 0, [pack(row=rows[a:b], back=back[a:b])])
    return run


def _score(model: Unigrams, key_type: pa.DataType) -> Callable:
    """Add up the tokens of one task's texts, as the buckets have told them."""
    names = ["key", "held_out", "n_tokens", "n_known", "base_score", "score"]
    fields = list(zip(names, [key_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, sums = [], None
        blocks = [x for t in (left, right) for x in _read(t.to_batches())]
        if not any(kind == TEXTS for kind, _, _ in blocks):
            return pa.schema(fields).empty_table()
        discounted = np.array(left.column("discounted")[0].as_py())
        for kind, first, body in blocks:
            if kind == TEXTS:
                texts.append((first, pa.ipc.open_stream(body.as_buffer()).read_all()))
        texts.sort(key=lambda x: x[0])
        start, size = texts[0][0], sum(t.num_rows for _, t in texts)
        known, base, score = np.zeros(size), np.zeros(size), np.zeros(size)
        seen_log = np.append(0.0, np.log10(discounted[1:]))
        for kind, first, body in blocks:
            if kind == COUNTS:
                x = unpack(body)
                row = np.cumsum(x["step"], dtype=np.int64) + (first - start)
                n, pair = x["n"].astype(np.int64), x["pair"].astype(np.int64)
                known += np.bincount(row, n > 0, size)
                base += np.bincount(row, np.log10(n + 1.0), size)
                score += np.bincount(row, np.where(pair > CUT, np.log10(np.maximum(pair, 1) - HALF), seen_log[np.minimum(pair, CUT)]) - np.log10(np.maximum(n, 1)), size)
            elif kind == BACK:
                x = unpack(body)
                score += np.bincount(x["row"] - start, x["back"], size)
        every = pa.concat_tables([t for _, t in texts])
        n = every.column("n").to_numpy()
        # Each text has one end, whose count is that of the texts learned from, as is the count of the start, its first context.
        return pa.Table.from_arrays([every.column("key").cast(key_type), every.column("held_out"), pa.array(n), pa.array(known.astype(np.int64)),
                                     pa.array(base - n * math.log10(model.tokens + model.types + 1)), pa.array(score)], names)
    return run


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of ``docs``: its key, ``held_out``, ``n_tokens`` (words
    and one end), ``n_known``, ``train_tokens``, ``base_score`` (unigrams with
    one added) and ``score``, log10 of the text's probability.

    ``held_out`` is a condition on the columns of ``docs``; the model learns
    from all texts for which it is false or null.  Null texts are empty: an
    end alone.  Repeated rows count as often as they are there.  Without any
    text to learn from every word is unknown, and every score is 0.

    The rows are numbered by their place in the input, so reading the same
    table again must give the same splits, as a table's files do."""
    require(docs, key, text)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BUCKET_BYTES + 1
    model = unigrams(rows, n, scratch_path(docs.sparkSession, f"unigrams/{uuid.uuid4().hex[:12]}"))
    kind = rows.schema["key"].dataType

    # Read three times after one shuffle: what a reader does not ask for it skips itself, as a filter would move below the
    # shuffle and make it another one.
    counted = rows.mapInArrow(_send(n, model.hot), BLOCK).groupBy("bucket").applyInArrow(_count(model, n), BLOCK).repartition("bucket")
    discounts = F.broadcast(counted.mapInArrow(_stats, "n array<long>").agg(F.array(*[F.coalesce(F.sum(F.col("n")[r]), F.lit(0)) for r in range(CUT + 2)]).alias("n"))
                            .mapInArrow(_discounts, "discounted array<double>"))      # one row
    told = counted.crossJoin(discounts)
    backs = told.groupBy("bucket").applyInArrow(_back_off(model, n), BLOCK)
    scored = told.groupBy("bucket").cogroup(backs.groupBy("bucket")).applyInArrow(
        _score(model, to_arrow_type(kind)), f"key {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
