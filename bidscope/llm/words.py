"""Words of whole texts, a few megabytes at a time, with numpy and Arrow.

All word rules here are rules on bytes of UTF-8: every byte of a non-ASCII
character belongs to a word, so a 256-entry table says which bytes do.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 8 << 20        # of text in one numpy pass

_BYTES = np.arange(256)
#: lower-cases A-Z only
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
KEEP = _BYTES.astype(np.uint8)
#: [^\x20\x09-\x0D]
NOT_SPACE = (_BYTES != 0x20) & ~((_BYTES >= 0x09) & (_BYTES <= 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and all beyond ASCII
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


class Words(NamedTuple):
    codes: np.ndarray        # of each word, an index into vocab
    vocab: pa.Array          # distinct words as bytes
    starts: np.ndarray       # of each text, its first word; one more at the end


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``most`` bytes of text, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, ends = 0, np.cumsum(size, dtype=np.int64)
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def split_words(texts: pa.Array, lower: np.ndarray = LOWER, inside: np.ndarray = NOT_SPACE) -> Words:
    data, offsets = text_buffers(texts)
    is_word = inside[lower[data]]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = is_word[begins]
    starts = np.searchsorted(np.flatnonzero(first), offsets)
    kept = lower[data[is_word]]
    at = np.append(np.flatnonzero(first[is_word]), len(kept)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(kept)])
    encoded = words.dictionary_encode()
    return Words(encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary, starts)


def hashes(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(w, seed) for w in vocab.to_pylist()), np.uint64, len(vocab))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(parts: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """One 64-bit hash of several aligned arrays of hashes, in order."""
    out = np.full(len(parts[0]), seed, np.uint64)
    for x in parts:
        out = mix((out + _STEP) ^ (x * _STEP))
    return out


def owners(starts: np.ndarray) -> np.ndarray:
    """Of each word, the index of its text."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def shingle_runs(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k words from each word on, and whether those lie in one
    text.  The whole sequence of a text with fewer words stands for it, at its
    first word."""
    h = hashes(words.vocab)[words.codes]
    n, starts = len(h), words.starts
    runs = np.zeros(n, np.uint64)
    if n >= k:
        runs[:n - k + 1] = chain([h[i:n - k + 1 + i] for i in range(k)], k)
    size = np.diff(starts)
    whole = np.arange(n) <= np.repeat(starts[1:] - k, size)
    for i in np.flatnonzero((size > 0) & (size < k)).tolist():
        a, b = starts[i], starts[i + 1]
        runs[a] = chain([h[j:j + 1] for j in range(a, b)], int(b - a))[0]
        whole[a] = True
    return runs, whole


def shingles(words: Words, k: int = 5, change=None) -> list[np.ndarray]:
    """Of each text, the sorted distinct hashes of its k-word shingles, which
    ``change`` may first turn into other numbers."""
    runs, whole = shingle_runs(words, k)
    if change is not None:
        runs = change(runs)
    size = np.diff(words.starts)
    n = np.where(size < k, np.minimum(size, 1), size - k + 1)
    flat, out, at = runs[whole], [], 0
    for m in n.tolist():
        s = np.sort(flat[at:at + m])
        at += m
        if m > 1:
            new = np.empty(m, bool)
            new[0] = True
            np.not_equal(s[1:], s[:-1], out=new[1:])
            s = s[new]
        out.append(s)
    return out
