"""Byte-level BPE by dynamic programming over prefixes.

The text is cut into pieces by the tokenizer's pattern.  In a piece, every
byte prefix has exactly one last token with which its encoding can end: the
token t that ends there, starts where a prefix with last token s ends, and
that no merge would ever join with s.  Those last tokens are stored, one for
each byte.  Walking them back gives the encoding of any prefix, more bytes
append without touching what is stored, and after an edit only the prefixes
from the edit on are computed, until they agree with the old ones again.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bidscope.llm.columns import require, with_columns
from bidscope.llm.words import SLICE_BYTES

#: Encodings of strings that a task may carry to its next slice of texts; it saves time and changes no result.
REMEMBERED = 250_000
_NONE = 1 << 60
_TOKEN = -1


class Vocabulary:
    """Ranks of byte strings, and for each token the two that merge into it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.longest = max(map(len, ranks))
        size = len(self.bytes_of)
        self.left, self.right = list(range(size)), list(range(size))
        self.merge: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        self.reached: dict[bytes, int] = {}
        self.tails: dict = {}          # tokens read from their last byte on; at _TOKEN the id of what was read
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self.bytes_of[rank] = token
            if len(token) == 1:
                self.reached[token] = rank
                continue
            for i in range(1, len(token)):
                a, b = self.reached.get(token[:i]), self.reached.get(token[i:])
                if a is not None and b is not None and self._apart(a, b):
                    self.left[rank], self.right[rank] = a, b
                    self.merge[a, b] = rank
                    self.reached[token] = rank
                    break
        for token, rank in self.reached.items():
            node = self.tails
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[_TOKEN] = rank

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def _apart(self, a: int, b: int) -> bool:
        """Whether the encoding of the bytes of a and b leaves both whole.

        The later built of the two tokens is opened step by step towards the
        border; a merge across the border that ranks before the piece still
        to be built would have come first."""
        bound = _NONE
        while True:
            joined = self.merge.get((a, b))
            if joined is not None and joined < bound:
                return False
            if a > b:
                bound, inner = a, self.right[a]
                if inner != a:
                    a = inner
                    continue
                bound, inner = b + 1, self.left[b]
                if inner == b:
                    return True
                b = inner
            else:
                bound, inner = b + 1, self.left[b]
                if inner != b:
                    b = inner
                    continue
                bound, inner = a, self.right[a]
                if inner == a:
                    return True
                a = inner

    def apart(self, a: int, b: int) -> bool:
        found = self.known.get((a, b))
        if found is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            found = self.known[a, b] = self._apart(a, b)
        return found


class Prefixes:
    """One piece and the last token of each of its byte prefixes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def _end(self, end: int) -> int:
        """The one token with which the prefix of ``end`` bytes can end."""
        node, known, last, piece, at = self.vocabulary.tails, self.vocabulary.known, self.last, self.piece, end
        while at:
            at -= 1
            node = node.get(piece[at])
            if node is None:
                break
            token = node.get(_TOKEN)
            if token is not None:
                if at == 0:
                    return token
                before = last[at - 1]
                fits = known.get((before, token))
                if fits or fits is None and self.vocabulary.apart(before, token):
                    return token
        raise ValueError("the vocabulary lacks a byte of the text")

    def append(self, more: bytes) -> "Prefixes":
        self.piece += more
        for end in range(len(self.last) + 1, len(self.piece) + 1):
            self.last.append(self._end(end))
        return self

    def edit(self, begin: int, stop: int, new: bytes) -> int:
        """Replace the bytes from begin to stop; returns how many prefixes
        were computed anew."""
        old, tail = self.last, len(self.piece) - stop
        self.piece = self.piece[:begin] + new + self.piece[stop:]
        self.last = old[:begin]
        fixed, n = len(self.piece) - tail, len(self.piece)
        alike = done = 0
        for end in range(begin + 1, n + 1):
            token = self._end(end)
            self.last.append(token)
            done += 1
            alike = alike + 1 if end > fixed and old[len(old) - (n - end) - 1] == token else 0
            if alike >= self.vocabulary.longest:
                self.last += old[len(old) - (n - end):]
                break
        return done

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the prefix of ``length`` bytes (all)."""
        at, out = len(self.piece) if length is None else length, []
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class Encoder:
    """Whole texts, as the pattern cuts them.

    A match never reaches over a single space between two characters that are
    no white space, except to start with that space.  So the text is first cut
    there, and a segment that came up before is not encoded again.  New pieces
    are encoded in sorted order, each by appending to the prefix that it
    shares with the one before."""

    _cut = re.compile(r"(?<=\S) (?=\S)")
    _uneven = re.compile(r"^ |\s |  | \s| $")

    def __init__(self, vocabulary: Vocabulary, pattern: str, remembered: int = REMEMBERED):
        self.vocabulary, self.find, self.remembered = vocabulary, regex.compile(pattern).findall, remembered
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.segments: dict[str, tuple[int, ...]] = {}       # by their text after the space
        self.names = list(map(str, range(len(vocabulary.bytes_of))))
        self.sizes = list(map(len, vocabulary.bytes_of))

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Encode new pieces in byte order: ``last`` holds the last token of
        each prefix of the present one, from which it is walked back."""
        ranks, tails, known, apart = (self.vocabulary.ranks, self.vocabulary.tails, self.vocabulary.known, self.vocabulary.apart)
        size = self.sizes
        last: list[int] = []
        before = b""
        for piece in sorted(pieces):            # code points sort as their bytes do
            raw = piece.encode()
            direct = ranks.get(raw)
            if direct is not None:
                self.pieces[piece] = (direct,)
                continue
            same = 0
            for a, b in zip(before, raw):
                if a != b:
                    break
                same += 1
            del last[same:]
            before = raw
            for at in range(same + 1, len(raw) + 1):
                node = tails
                while True:
                    at -= 1
                    node = node[raw[at]]
                    if _TOKEN in node:
                        token = node[_TOKEN]
                        if at == 0:
                            break
                        pair = (last[at - 1], token)
                        fits = known.get(pair)
                        if fits or fits is None and apart(*pair):
                            break
                last.append(token)
            at, ids = len(raw), []
            while at:
                token = last[at - 1]
                ids.append(token)
                at -= size[token]
            self.pieces[piece] = tuple(ids[::-1])

    def _learn(self, segments: set[str], pieces: set[str]) -> None:
        if len(self.segments) > self.remembered:
            self.segments.clear()
        if len(self.pieces) > self.remembered:
            self.pieces.clear()
        segments = segments.difference(self.segments)
        cut = [self.find(" " + s) for s in segments]
        self._learn_pieces(pieces.union(*cut).difference(self.pieces))
        get = self.pieces.__getitem__
        self.segments.update((s, get(p[0]) if len(p) == 1 else tuple(chain.from_iterable(map(get, p))))
                             for s, p in zip(segments, cut))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        # Millions of small tuples and no cycles: the collector would walk them in vain.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode_all(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_all(self, texts: list[str]) -> list[list[int]]:
        parts = [self._cut.split(text) if self._uneven.search(text) else text.split(" ") for text in texts]
        first = [self.find(p[0]) for p in parts]
        for p in parts:
            p[0] = ""                            # the text's start has no space before it
        segments = set().union(*parts)
        segments.discard("")
        self._learn(segments, set(chain.from_iterable(first)))
        self.segments[""] = ()
        get, piece = self.segments.__getitem__, self.pieces.__getitem__
        return [list(chain(chain.from_iterable(map(piece, f)), chain.from_iterable(map(get, p)))) for f, p in zip(first, parts)]

    def forget(self) -> None:
        """Give back the memory of encodings; the worker may do other work next."""
        self.pieces, self.segments = {}, {}
        self.vocabulary.known.clear()

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def ids_digest(self, ids: list[int]) -> str:
        return hashlib.sha256(" ".join(map(self.names.__getitem__, ids)).encode()).hexdigest()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, remembered: int = REMEMBERED) -> Encoder:
    """Of this worker; built when first asked for."""
    return Encoder(Vocabulary.load(path), pattern, remembered)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text",
                     keep: list[str] | None = None, with_ids: bool = True, remembered: int = REMEMBERED,
                     slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the decimal ids, joined
    by one space), ``decoded_sha256`` (of the bytes that the ids decode to)
    and, unless ``with_ids`` is false, ``ids``.

    ``path`` is a file of base64 tokens and ranks that every machine has, as
    the tokenizer package installs it.  Null and empty texts have no ids.
    Texts of any length are encoded whole, equal rows alike, columns with
    clashing names are replaced.  One pass over the table, no shuffle.  Less
    ``remembered`` and smaller slices take less memory and more time; below
    ``REMEMBERED`` a task gives the vocabulary back as well."""
    require(docs, text)

    def make(part: pa.RecordBatch) -> list:
        e = encoder(path, pattern, remembered)
        n, ids_sha, decoded_sha, all_ids = [], [], [], []
        for ids in e.encode_all([t or "" for t in part.column(text).to_pylist()]):
            n.append(len(ids))
            ids_sha.append(e.ids_digest(ids))
            decoded_sha.append(hashlib.sha256(e.decode(ids)).hexdigest())
            if with_ids:
                all_ids.append(pa.array(ids, pa.int32()))
        out = [pa.array(n, pa.int64()), ids_sha, decoded_sha]
        if with_ids:
            flat = pa.concat_arrays(all_ids)
            out.append(pa.ListArray.from_arrays(pa.array([0, *_cumulated(n)], pa.int32()), flat))
        return out

    def done() -> None:
        encoder(path, pattern, remembered).forget()
        if remembered < REMEMBERED:
            encoder.cache_clear()

    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return with_columns(docs, text, added, make, keep, done, slice_bytes)


def _cumulated(n: list[int]) -> list[int]:
    total, out = 0, []
    for x in n:
        total += x
        out.append(total)
    return out


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids decode to; null ids decode to
    no bytes."""
    import pyspark.sql.types as T
    require(encoded, ids)
    stay = [c for c in encoded.columns if c != out]
    schema = T.StructType([encoded.schema[c] for c in stay] + [T.StructField(out, T.BinaryType())])

    def run(batches):
        e = encoder(path, pattern)
        for batch in batches:
            raw = [e.decode(x) if x else b"" for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in stay] + [pa.array(raw, pa.binary())], [*stay, out])

    return encoded.select(*stay).mapInArrow(run, schema)
