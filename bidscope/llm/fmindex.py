"""Benchmark decontamination with an FM-index for each training shard.

A shard is some megabytes of whole texts, as a task reads them.  Its index is
over words: the Burrows-Wheeler transform of the shard as a wavelet matrix
with popcount ranks, and the text positions of sampled suffixes.  Test phrases
are searched backwards, all at once, one word a step; the positions where they
occur are found by walking back to a sampled suffix.  Spans of occurrences are
merged for each document.

The index does not depend on the test phrases.  It is written once and
searched by blocks of phrases of a bounded number of words.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm.columns import give_back, require
from bidscope.llm.words import ALNUM, LOWER, slices, split_words

SHARD_BYTES = 6 << 20         # of text in a shard; a longer text is a shard of its own
SAMPLED = 16                  # every 16th position has its suffix marked, and each text's first
WINDOW = 10                   # words in a test phrase
BLOCK_WORDS = 1_000_000       # of test items searched at a time

_ONE = np.uint64(1)


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.words, self.counts = words, counts

    @classmethod
    def of(cls, bits: np.ndarray) -> "Bits":
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        counts = np.zeros(len(words), np.int32)
        np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:])
        return cls(words, counts)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before ``at``."""
        block = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.counts[block] + np.bitwise_count(self.words[block] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & _ONE).astype(bool)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` (numbers from 0, the last one smaller than none
    other but itself) in order: runs of as many symbols as a 63-bit key holds
    are sorted first, then only suffixes that still tie, by doubled runs."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    run = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    for i in range(min(run, n)):
        key[:n - i] |= text[i:].astype(np.int64) << (bits * (run - 1 - i))
    order = np.argsort(key)
    ordered = key[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1                                     # what lies beyond the end comes first
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return order
        suffix = order[slots]
        key = rank[suffix] << 32 | (rank[np.minimum(suffix + run, n)] + 1)
        by = np.argsort(key)
        order[slots], key = suffix[by], key[by]
        starts = np.append(True, key[1:] != key[:-1])
        new[slots] = starts
        rank[order[slots]] = np.maximum.accumulate(np.where(starts, slots, 0))
        run *= 2


class Index(NamedTuple):
    """Of one shard: its texts' words, 0 after each text."""

    levels: list[Bits]        # of the wavelet matrix, from the highest bit
    zeros: np.ndarray         # of each level
    before: np.ndarray        # of each symbol, how many symbols of the shard are smaller
    base: np.ndarray          # of each symbol, where its run starts below the last level
    marked: Bits              # suffixes whose position is stored
    positions: np.ndarray     # of those
    starts: np.ndarray        # of each text, its first position; one more at the end
    vocab: pa.Array           # word of symbol i + 1

    @classmethod
    def build(cls, texts: pa.Array) -> "Index":
        words = split_words(texts, LOWER, ALNUM)
        n_texts, n = len(words.starts) - 1, len(words.codes)
        starts = words.starts + np.arange(n_texts + 1)
        ends = starts[1:] - 1
        is_word = np.ones(n + n_texts, bool)
        is_word[ends] = False
        text = np.empty(n + n_texts, np.int64)
        text[is_word] = words.codes + n_texts
        text[ends] = np.arange(n_texts)              # ends differ, so that copies part there
        order = suffix_order(text)
        symbols = np.maximum(text - (n_texts - 1), 0)
        last = symbols[order - 1]
        n_symbols = len(words.vocab) + 1
        before = np.append(0, np.cumsum(np.bincount(symbols, minlength=n_symbols))[:-1])
        levels, zeros = [], []
        last = last.astype(np.uint32)
        for level in reversed(range(max(1, (n_symbols - 1).bit_length()))):
            bit = (last >> np.uint32(level) & np.uint32(1)).astype(bool)
            levels.append(Bits.of(bit))
            low = last[~bit]
            zeros.append(len(low))
            last = np.concatenate([low, last[bit]])
        first = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        base = np.zeros(n_symbols, np.int64)
        base[last[first]] = first
        sampled = (order & (SAMPLED - 1)) == 0
        at_start = np.zeros(len(text), bool)
        at_start[starts[:-1]] = True
        sampled |= at_start[order]
        return cls(levels, np.array(zeros), before, base, Bits.of(sampled), order[sampled].astype(np.int32), starts, words.vocab)

    def dump(self) -> bytes:
        out = io.BytesIO()
        data = np.frombuffer(_dump_vocab(self.vocab), np.uint8)
        np.savez(out, zeros=self.zeros, before=self.before.astype(np.int32), base=self.base.astype(np.int32),
                 words=np.stack([x.words for x in [*self.levels, self.marked]]),
                 counts=np.stack([x.counts for x in [*self.levels, self.marked]]),
                 positions=self.positions, starts=self.starts, vocab=data)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> "Index":
        z = np.load(io.BytesIO(raw))
        bits = [Bits(w, c) for w, c in zip(z["words"], z["counts"])]
        vocab = pa.ipc.open_stream(z["vocab"].tobytes()).read_all().column(0).combine_chunks()
        return cls(bits[:-1], z["zeros"], z["before"].astype(np.int64), z["base"].astype(np.int64), bits[-1], z["positions"], z["starts"], vocab)

    def symbols_of(self, words: pa.Array) -> np.ndarray:
        """Symbols of words, -1 for those that the shard lacks."""
        at = pc.index_in(words.cast(self.vocab.type), self.vocab)
        return pc.fill_null(at, -2).to_numpy(zero_copy_only=False).astype(np.int64) + 1

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at`` in the transform."""
        top = len(self.levels) - 1
        for i, level in enumerate(self.levels):
            ones = level.rank(at)
            at = np.where(symbol >> (top - i) & 1, self.zeros[i] + ones, at - ones)
        return at - self.base[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the phrases (rows of symbols, right-aligned) that occur: which
        they are, and the ranges of their suffixes."""
        which = np.flatnonzero((lengths > 0) & ((phrases >= 1) | (np.arange(phrases.shape[1]) < phrases.shape[1] - lengths[:, None])).all(1))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), int(self.starts[-1]), np.int64)
        for back in range(1, phrases.shape[1] + 1):
            go = lengths[which] >= back
            if not go.any():
                break
            symbol = phrases[which[go], -back]
            low[go] = self.before[symbol] + self._down(symbol, low[go])
            high[go] = self.before[symbol] + self._down(symbol, high[go])
            found = low < high
            which, low, high = which[found], low[found], high[found]
        return which, low, high

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: one step back at a time until a marked
        one.  A text's first position is marked, so no step leaves a text."""
        out, top = np.empty(len(suffixes), np.int64), len(self.levels) - 1
        todo, at = np.arange(len(suffixes)), suffixes
        steps = 0
        while len(todo):
            done = self.marked.get(at)
            out[todo[done]] = self.positions[self.marked.rank(at[done])] + steps
            todo, at = todo[~done], at[~done]
            symbol = np.zeros(len(at), np.int64)
            for i, level in enumerate(self.levels):
                bit, ones = level.get(at), level.rank(at)
                symbol |= bit.astype(np.int64) << (top - i)
                at = np.where(bit, self.zeros[i] + ones, at - ones)
            at = self.before[symbol] + at - self.base[symbol]
            steps += 1
        return out


def _dump_vocab(vocab: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({"word": vocab})
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each shard: ``shard``, ``payload`` and, in the order of its
    texts, ``keys`` and ``n_words``.  One pass, no shuffle; the caller writes
    it.  Null texts have no words; keys may be null or repeat."""
    require(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, text, shard_bytes):
                index = Index.build(part.column(text))
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{task}-{k}"]), pa.array([index.dump()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(key)),
                    pa.array([np.diff(index.starts) - 1], pa.list_(pa.int64()))], ["shard", "payload", "keys", "n_words"])
                k += 1
        give_back()

    return docs.select(key, text).mapInArrow(run, f"shard string, payload binary, keys array<{kind}>, n_words array<long>")


class Phrases(NamedTuple):
    """Distinct windows of a block of test items."""

    vocab: pa.Array
    words: np.ndarray             # rows of indexes into vocab, right-aligned
    lengths: np.ndarray
    items: list[list[str]]        # of each window, the items that have it


def phrases_of(items: list[tuple[str, str | None]], window: int = WINDOW) -> Phrases:
    """Windows of ``window`` words of each item; an item of fewer words, but
    not none, is one window."""
    words = split_words(pa.array([t or "" for _, t in items], pa.string()), LOWER, ALNUM)
    found: dict[tuple[int, ...], list[str]] = {}
    for i, (item, _) in enumerate(items):
        codes = words.codes[words.starts[i]:words.starts[i + 1]].tolist()
        for at in range(max(1, len(codes) - window + 1) if codes else 0):
            owners = found.setdefault(tuple(codes[at:at + window]), [])
            if item not in owners:
                owners.append(item)
    rows = np.zeros((len(found), window), np.int64)
    lengths = np.zeros(len(found), np.int64)
    for i, codes in enumerate(found):
        rows[i, window - len(codes):] = codes
        lengths[i] = len(codes)
    return Phrases(words.vocab, rows, lengths, list(found.values()))


def occurrences(index: Index, phrases: Phrases) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """For each text with an occurrence: its number, merged spans of word
    positions from its first word, and the items."""
    if not len(phrases.words):
        return
    symbols = index.symbols_of(phrases.vocab)[phrases.words]
    which, low, high = index.search(symbols, phrases.lengths)
    if not len(which):
        return
    count = high - low
    phrase = np.repeat(which, count)
    suffixes = np.arange(count.sum()) + np.repeat(low - np.append(0, np.cumsum(count)[:-1]), count)
    at = index.locate(suffixes)
    by = np.argsort(at, kind="stable")
    at, phrase = at[by], phrase[by]
    end = at + phrases.lengths[phrase]
    text = np.searchsorted(index.starts, at, "right") - 1
    cuts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(text))):
        first, spans = int(index.starts[text[a]]), []
        for x, y in zip((at[a:b] - first).tolist(), (end[a:b] - first).tolist()):
            if spans and x <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(y, spans[-1][1]))
            else:
                spans.append((x, y))
        names = {name for p in np.unique(phrase[a:b]).tolist() for name in phrases.items[p]}
        yield int(text[a]), spans, sorted(names)


def search_index(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text",
                 window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents of a written index with occurrences of windows of ``items``:
    ``shard``, ``number`` (in the shard), ``spans`` (begin and end words) and
    ``items`` (their keys as strings, in order; '' for a null key).

    The items come in blocks of bounded size, each sent to the tasks that
    search every shard; what the blocks find is merged for each document."""
    require(items, key, text)
    spark, found = index.sparkSession, None
    for block in _blocks(items.select(F.coalesce(F.col(key).cast("string"), F.lit("")), text), block_words):
        shared = spark.sparkContext.broadcast(phrases_of(block, window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload")):
                    rows = list(occurrences(Index.load(payload.as_buffer().to_pybytes()), shared.value))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([shard] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([[{"begin": a, "end": b} for a, b in r[1]] for r in rows], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                        pa.array([r[2] for r in rows], pa.list_(pa.string()))], ["shard", "number", "spans", "items"])
            give_back()

        hits = index.select("shard", "payload").mapInArrow(
            run, "shard string, number int, spans array<struct<begin:long,end:long>>, items array<string>")
        found = hits if found is None else found.union(hits)
    if found is None:
        return spark.createDataFrame([], "shard string, number int, spans array<struct<begin:long,end:long>>, items array<string>")
    merged = F.expr("""aggregate(array_sort(flatten(collect_list(spans))), array(named_struct('begin', -1L, 'end', -1L)),
        (done, x) -> if(x.begin <= element_at(done, -1).end,
            concat(slice(done, 1, size(done) - 1),
                   array(named_struct('begin', element_at(done, -1).begin, 'end', greatest(x.end, element_at(done, -1).end)))),
            concat(done, array(x))),
        done -> slice(done, 2, size(done)))""")
    return found.groupBy("shard", "number").agg(
        merged.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[str, str | None]]]:
    block, size = [], 0
    for row in items.toLocalIterator():
        size += len(row[1] or "") // 2 + 1          # no text has more words
        if block and size > most:
            yield block
            block, size = [], len(row[1] or "") // 2 + 1
        block.append((row[0], row[1]))
    if block:
        yield block


def contamination(index: DataFrame, items: DataFrame, key: str = "doc_id", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each document of a written index: its key, ``n_words``, ``n_hit``
    (words inside any occurrence), ``n_items``, ``items_sha256`` (of the keys
    of items with occurring windows, sorted as strings, comma-joined),
    ``contaminated`` and ``spans``."""
    found = search_index(index, items, window=window, block_words=block_words)
    docs = index.select("shard", F.posexplode(F.arrays_zip("keys", "n_words")).alias("number", "doc"))
    none = F.array().cast("array<string>")
    hit = F.aggregate(F.coalesce("spans", F.array().cast("array<struct<begin:long,end:long>>")), F.lit(0).cast("long"), lambda n, s: n + s.end - s.begin)
    return (docs.join(found, ["shard", "number"], "left")
            .select(F.col("doc.keys").alias(key), F.col("doc.n_words").alias("n_words"), hit.alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
                    (hit > 0).alias("contaminated"), "spans"))


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what lies between them."""
    raw = text.encode()
    words = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:words[a][0]])
        at = words[b - 1][1]
    return b"".join([*out, raw[at:]]).decode()
