"""Conversation structure repair: cheapest edits by a run-length DP.

The rows of a conversation, in order of turn, are one symbol each: what the
role begins with and what fault the row has.  A repaired conversation's roles
read ``(s?(ua)+)?``, which four states follow: nothing yet, after the system
row, after a user row, after an assistant row.  A symbol is a 4 x 4 matrix of
min-plus algebra, the cheapest way from state to state past that row, with
rows inserted before it.  Equal symbols next to each other are a run; a run is
advanced through its matrix's binary powers, which are cached.  Costs to the
end, from those powers, then decide every edit from the first row on, the
ASCII-least initial of the cheapest ones.

Rows are sorted over range partitions of (conversation, turn), so that a
conversation may lie in many tasks.  One that a task surely holds whole is
repaired there.  Of the others each task gives one matrix; they are combined
per conversation (one row a task), which says in what state and with what
costs to the end each task's part begins and ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm.columns import arrow_schema, give_back, require
from bidscope.llm.words import slices
from bidscope.session import stage

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
INF = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)             # the state after a row of user or assistant that fits
NAMES = {USER: "user", ASSISTANT: "assistant"}
ACCEPT = (0, INF, INF, 0)
CHUNK_ROWS, CHUNK_BYTES = 10_000, 1 << 20        # of a stored part of a conversation
SPACE = " \t\n\x0b\x0c\r"

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def multiply(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(4)), INF) for j in range(4)) for i in range(4))


def costs_before(m: Matrix, v: Vector) -> Vector:
    return tuple(min(min(m[i][k] + v[k] for k in range(4)), INF) for i in range(4))


IDENTITY: Matrix = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))


def _inserts() -> Matrix:
    """Any number of inserted rows; two of them lead back to the same state."""
    one = tuple(tuple(0 if i == j else INSERT if NEXT[i] == j else INF for j in range(4)) for i in range(4))
    return multiply(one, multiply(one, one))


INSERTS = _inserts()


def keeps(symbol: str, state: int) -> int | None:
    """The state after keeping a row, or None if its role does not fit."""
    role = symbol.lower()
    if role == "s":
        return SYSTEM if state == START else None
    after = NEXT[state]
    return after if role == {USER: "u", ASSISTANT: "a"}[after] else None


@lru_cache(None)
def power(symbol: str, bit: int) -> Matrix:
    """The symbol's matrix to the power 2 ** bit.  Symbols: s, u, a or x (any
    other role), capital where the row is truncated; d must be deleted."""
    if bit:
        half = power(symbol, bit - 1)
        return multiply(half, half)
    row = [[INF] * 4 for _ in range(4)]
    for state in range(4):
        row[state][state] = DELETE
        if symbol != "d":
            extra = TRUNCATED if symbol.isupper() else 0
            row[state][NEXT[state]] = min(row[state][NEXT[state]], REROLE + extra)
            kept = keeps(symbol, state)
            if kept is not None:
                row[state][kept] = min(row[state][kept], extra)
    return multiply(INSERTS, tuple(map(tuple, row)))


@lru_cache(1 << 16)
def _advance(symbol: str, bit: int, v: Vector) -> tuple[Vector, int]:
    new = costs_before(power(symbol, bit), v)
    least = min(new)
    return tuple(min(x - least, INF) for x in new), least


def advance(symbol: str, n: int, v: Vector) -> tuple[Vector, int]:
    """Costs to the end before a run of ``n`` symbols from those after it,
    less their smallest, and that."""
    added = 0
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            v, least = _advance(symbol, bit, v)
            added += least
    return v, added


@lru_cache(1 << 16)
def choose(symbol: str, state: int, after: Vector) -> tuple[str, int]:
    """The initials of the edits up to and with this row, and the state after
    it, given the costs to the end after it."""
    before, letters = costs_before(power(symbol, 0), after), ""
    extra = TRUNCATED if symbol.isupper() else 0
    while True:
        left = before[state]
        if left == DELETE + after[state]:
            return letters + "D", state
        if left == INSERT + before[NEXT[state]]:
            letters, state = letters + "I", NEXT[state]
            continue
        kept = None if symbol == "d" else keeps(symbol, state)
        if kept is not None and left == extra + after[kept]:
            return letters + "K", kept
        return letters + "R", NEXT[state]


def runs_of(symbols: str, copies: list[int]) -> list[tuple[str, int]]:
    """Runs of a part's rows; of a row that occurs more than once all but the
    first must go."""
    if all(n == 1 for n in copies):
        return [(s, len(list(g))) for s, g in groupby(symbols)]
    flat = [x for s, n in zip(symbols, copies) for x in ((s, 1), ("d", n - 1)) if x[1]]
    return [(s, sum(n for _, n in g)) for s, g in groupby(flat, key=lambda x: x[0])]


def matrix(runs: list[tuple[str, int]]) -> Matrix:
    out = IDENTITY
    for symbol, n in runs:
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                out = multiply(out, power(symbol, bit))
    return out


def ending(state: int, last: bool) -> tuple[str, int]:
    """The rows to insert after the last one."""
    letters = ""
    while last and ACCEPT[state]:
        letters, state = letters + "I", NEXT[state]
    return letters, state


def closing(v: Vector, last: bool) -> Vector:
    return costs_before(INSERTS, v) if last else v


def unroll(runs: list[tuple[str, int]], state: int, after: Vector) -> tuple[str, int, Vector]:
    """The audit of a part that begins in ``state``, the state after it, and
    the costs to the end before it (but for a constant)."""
    ends = [after]
    for symbol, n in reversed(runs):
        ends.append(advance(symbol, n, ends[-1])[0])
    ends.reverse()
    audit = []
    for k, (symbol, n) in enumerate(runs):
        if symbol == "d":                          # at once: nothing sorts before D, and the state stays
            audit.append("D" * n)
            continue
        inside = [ends[k + 1]]
        for _ in range(n - 1):
            inside.append(_advance(symbol, 0, inside[-1])[0])
        for v in reversed(inside):
            letters, state = choose(symbol, state, v)
            audit.append(letters)
    return "".join(audit), state, ends[0]


def price(audit: str, symbols: str, copies: list[int]) -> int:
    """What the edits cost: kept and renamed truncated rows cost more."""
    total = DELETE * audit.count("D") + INSERT * audit.count("I") + REROLE * audit.count("R")
    edits = audit.replace("I", "")
    at = 0
    for s, n in zip(symbols, copies):
        total += TRUNCATED * (s.isupper() and edits[at] != "D")
        at += n
    return total


def repaired(audit: str, state: int, copies: list[int], roles: list, texts: list) -> tuple[list[str], list[str]]:
    """The rows that the edits leave.  ``state`` is the one before them."""
    out_roles, out_texts, row, copy = [], [], 0, 0
    for letter in audit:
        if letter == "K":
            out_roles.append(roles[row])
            out_texts.append(texts[row])
            state = SYSTEM if roles[row][:1] == "s" else NEXT[state]
        elif letter != "D":
            state = NEXT[state]
            out_roles.append(NAMES[state])
            out_texts.append(texts[row] if letter == "R" else "")
        if letter != "I":
            copy += 1
            if copy == copies[row]:
                row, copy = row + 1, 0
    return out_roles, out_texts


STATS = "blank long, duplicate long, truncated long, illegal long, lo long, hi long, turns long, first_initial string, last_initial string"
_PART = f"conv_id long, part int, seq int, whole boolean, symbols string, copies array<long>, roles array<string>, texts array<string>, {STATS}, audit string, cost long"


class _Part:
    """Rows of one conversation that follow each other in a task."""

    def __init__(self, conv, part: int, seq: int):
        self.conv, self.part, self.seq = conv, part, seq
        self.symbols, self.copies, self.roles, self.texts, self.size = [], [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.lo = self.hi = self.first = self.last = None

    def add(self, turn, role: str, text: str, n: int, first: bool, fault: str, met) -> None:
        initial = role[:1]
        again = n if fault == "blank" or not first else n - 1
        self.blank += n if fault == "blank" else 0
        self.duplicate += 0 if fault == "blank" else again
        keep = first and fault != "blank"
        self.truncated += keep and fault == "truncated"
        kind = initial if initial and initial in "sua" else "x"
        self.symbols.append(("d" if not keep else kind.upper() if fault == "truncated" else kind))
        self.copies.append(n)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += n - 1 if initial + initial not in LEGAL else 0
        if self.first is None:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.turns += turn != met
            self.lo = turn if self.lo is None else self.lo
            self.hi = turn

    def row(self, whole: bool) -> tuple:
        symbols = "".join(self.symbols)
        roles, texts, audit, cost = self.roles, self.texts, None, None
        if whole:
            after = closing(ACCEPT, True)
            audit, state, _ = unroll(runs_of(symbols, self.copies), START, after)
            audit += ending(state, True)[0]
            cost = price(audit, symbols, self.copies)
            roles, texts = repaired(audit, START, self.copies, roles, texts)
        return (self.conv, self.part, self.seq, whole, symbols, self.copies, roles, texts, self.blank, self.duplicate, self.truncated,
                self.illegal, self.lo, self.hi, self.turns, self.first, self.last, audit, cost)


LEGAL = ("su", "ua", "au")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _parts(batches: Iterator[pa.RecordBatch], chunk_rows: int) -> Iterator[pa.RecordBatch]:
    """Packs sorted rows into parts of conversations; a part is the whole
    conversation if others lie before and after it in the task."""
    from pyspark import TaskContext
    number, schema = TaskContext.get().partitionId(), arrow_schema(_PART)
    out, size, current, first, met = [], 0, None, True, None
    for batch in batches:
        for piece in slices(batch, "text", CHUNK_BYTES):
            for conv, turn, role, text, n, is_first, fault in zip(*[c.to_pylist() for c in piece.columns]):
                if current is not None and current.conv != conv:
                    out.append(current.row(whole=not first and current.seq == 0))
                    size += current.size
                    current, first = None, False
                elif current is not None and (len(current.copies) >= chunk_rows or current.size >= CHUNK_BYTES):
                    out.append(current.row(False))
                    size += current.size
                    last, seq = current.last, current.seq + 1
                    current = _Part(conv, number, seq)
                    current.last, current.first = last, role[:1]
                if current is None:
                    current, met = _Part(conv, number, 0), None
                current.add(turn, role, text, n, is_first, fault, met)
                met = turn if turn is not None else met
                if len(out) >= 1000 or size >= 4 * CHUNK_BYTES:
                    yield _batch(out, schema)
                    out, size = [], 0
    if current is not None:
        out.append(current.row(False))
    if out:
        yield _batch(out, schema)
    give_back()


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for what a task has of a conversation: its matrix and counts."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["seq"])
    total = IDENTITY
    for r in rows:
        total = multiply(total, matrix(runs_of(r["symbols"], r["copies"])))
    known = [r for r in rows if r["lo"] is not None]
    yield _batch([(rows[0]["conv_id"], rows[0]["part"], [x for line in total for x in line],
                   sum(r["illegal"] for r in rows), known[0]["lo"] if known else None, known[-1]["hi"] if known else None,
                   sum(r["turns"] for r in rows), rows[0]["first_initial"], rows[-1]["last_initial"])], arrow_schema(_MATRIX))


_MATRIX = "conv_id long, part int, matrix array<long>, illegal long, lo long, hi long, turns long, first_initial string, last_initial string"
_ENDS = "conv_id long, part int, after array<long>, last boolean, illegal long, gaps long"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs to the end after each task's part of one conversation, and in the
    first part's row what counts over all of them."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"])
    after, ends = closing(ACCEPT, True), []
    for r in reversed(rows):
        ends.append(after)
        m = r["matrix"]
        after = costs_before(tuple(tuple(m[4 * i:4 * i + 4]) for i in range(4)), after)
        after = tuple(min(x - min(after), INF) for x in after)
    ends.reverse()
    illegal, turns, hi = 0, 0, None
    for k, r in enumerate(rows):
        illegal += r["illegal"] + (k > 0 and rows[k - 1]["last_initial"] + r["first_initial"] not in LEGAL)
        turns += r["turns"] - (hi is not None and r["lo"] == hi)
        hi = r["hi"] if r["hi"] is not None else hi
    lo = next((r["lo"] for r in rows if r["lo"] is not None), None)
    gaps = 0 if lo is None else hi - lo + 1 - turns
    yield _batch([(r["conv_id"], r["part"], list(e), k + 1 == len(rows), illegal if not k else 0, gaps if not k else 0)
                  for k, (r, e) in enumerate(zip(rows, ends))], arrow_schema(_ENDS))


_WAYS = "conv_id long, part int, seq int, after array<long>, last boolean, enters array<int>, leaves array<int>, final boolean"
_ENTRY = "conv_id long, part int, entry int"
_DONE = "conv_id long, part int, seq int, audit string, cost long, roles array<string>, texts array<string>"


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk that a task has of a conversation the costs to the end
    after it, and in what states it begins and ends, for each state in which
    the task's part may begin."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["seq"])
    v, ends = tuple(rows[0]["after"]), []
    for r in reversed(rows):
        ends.append(v)
        for symbol, n in reversed(runs_of(r["symbols"], r["copies"])):
            v, _ = advance(symbol, n, v)
    states, out = list(range(4)), []
    for k, (r, v) in enumerate(zip(rows, reversed(ends))):
        after = {s: unroll(runs_of(r["symbols"], r["copies"]), s, v)[1] for s in set(states)}
        leaves, final = [after[s] for s in states], k + 1 == len(rows)
        out.append((r["conv_id"], r["part"], r["seq"], list(v), r["last"] and final, states, leaves, final))
        states = leaves
    yield _batch(out, arrow_schema(_WAYS))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In which state each task's part of one conversation begins."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"])
    state, out = START, []
    for r in rows:
        out.append((r["conv_id"], r["part"], state))
        state = r["leaves"][state]
    yield _batch(out, arrow_schema(_ENTRY))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_DONE)
    for batch in batches:
        for r in (r for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist()):
            state = r["enters"][r["entry"]]
            audit, after, _ = unroll(runs_of(r["symbols"], r["copies"]), state, tuple(r["after"]))
            audit += ending(after, r["last"])[0]
            roles, texts = repaired(audit, state, r["copies"], r["roles"], r["texts"])
            yield _batch([(r["conv_id"], r["part"], r["seq"], audit, price(audit, r["symbols"], r["copies"]), roles, texts)], schema)
    give_back()


def _with(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """``a`` with the columns of ``b``; null keys are equal."""
    renamed = b.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return a.join(renamed, on).drop(*[f"_{k}" for k in keys])


def repair(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Repairs every conversation of (conv_id, turn, role, text).

    The first table has one row for each stored part of a conversation, in
    order of (part, seq): audit (initials of its edits), cost, and roles and
    texts of the rows that are left.  Most conversations have one part.  The
    second has one row a conversation: gaps, blank, duplicate, truncated,
    illegal, before the repair.

    Rows are taken by turn, null turns first, those of one turn by role and
    then by a digest of role and text.  A null role or text is one space; so
    the row of a null text is blank.  A role counts by its first character; a
    role that is empty or begins otherwise can only be renamed or deleted.
    Rows without a conv_id are one conversation.  Repeated rows are kept as a
    count, long texts stay whole, other columns are not read."""
    require(conversations, "conv_id", "turn", "role", "text")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                blank("role").alias("role"), blank("text").alias("text"))
    rows = rows.withColumn("said", F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary")))
    rows = rows.withColumn("row", F.unhex(F.md5(F.concat_ws(":", blank("conv_id"), blank("turn"), "said").cast("binary"))))
    once = rows.groupBy("row").agg(*[F.any_value(c).alias(c) for c in ("conv_id", "turn", "role", "text", "said")], F.count("*").alias("n"))
    firsts = rows.groupBy("conv_id", "said").agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"), F.col("row")))["row"].alias("row"))
    told = once.join(firsts.select("row", F.lit(True).alias("first")), "row", "left")
    words = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(words == "", "blank").when(~F.substring(words, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    key = ["conv_id", "turn", "role", "said"]
    sorted_rows = told.withColumn("fault", fault).repartitionByRange(*key).sortWithinPartitions(*key).select(
        "conv_id", "turn", "role", "text", "n", F.coalesce("first", F.lit(False)).alias("first"), "fault")
    parts = stage(sorted_rows.mapInArrow(lambda batches: _parts(batches, chunk_rows), _PART), "conversation-parts")

    opened = parts.where("not whole")
    light = opened.drop("roles", "texts", "audit", "cost")
    group = ["conv_id", "part"]
    matrices = light.groupBy(*group).applyInArrow(_matrices, _MATRIX)
    ends = stage(matrices.groupBy("conv_id").applyInArrow(_ends, _ENDS), "conversation-ends")
    costs = ends.select(*group, "after", "last")
    ways = stage(_with(light, costs, *group).groupBy(*group).applyInArrow(_ways, _WAYS), "conversation-ways")
    entries = ways.where("final").groupBy("conv_id").applyInArrow(_entries, _ENTRY)
    ways = _with(ways.drop("leaves", "final"), entries, *group)
    done = _with(opened.select(*group, "seq", "symbols", "copies", "roles", "texts"), ways, *group, "seq").mapInArrow(_solved, _DONE)
    whole = parts.where("whole")
    pieces = whole.select(*[c.split()[0] for c in _DONE.split(", ")], F.lit(True).alias("whole")).unionByName(done.withColumn("whole", F.lit(False)))

    counts = ("blank", "duplicate", "truncated")
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0))
    some = light.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts])
    over = ends.groupBy("conv_id").agg(F.sum("gaps").alias("gaps"), F.sum("illegal").alias("illegal"))
    columns = ["conv_id", "gaps", *counts, "illegal"]
    stats = whole.withColumn("gaps", gaps).select(columns).unionByName(_with(some, over, "conv_id").select(columns))
    return pieces, stats


def damage(conversations: DataFrame) -> DataFrame:
    """Damages rows by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20:
    0 drops the row, 1 empties its text, 2 removes its ends of sentences, 3
    repeats it, 4 makes it the user's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind != 0")
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("copy")).drop("copy")


_DIGEST = "conv_id long, audit string, cost long, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests over the sorted parts of conversations, one part in memory."""
    schema = arrow_schema(_DIGEST)
    conv, audit, cost, hashed, any_row = None, None, 0, None, False
    for batch in batches:
        for r in batch.to_pylist():
            if hashed is None or r["conv_id"] != conv:
                if hashed is not None:
                    yield _batch([(conv, "".join(audit), cost, hashed.hexdigest())], schema)
                conv, audit, cost, hashed, any_row = r["conv_id"], [], 0, hashlib.sha256(), False
            audit.append(r["audit"])
            cost += r["cost"]
            for role, text in zip(r["roles"], r["texts"]):
                hashed.update((("\n" if any_row else "") + role + ":" + text).encode())
                any_row = True
    if hashed is not None:
        yield _batch([(conv, "".join(audit), cost, hashed.hexdigest())], schema)


def digest(conversations: DataFrame, repaired_parts: DataFrame, stats: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: the counts, the whole
    audit and its cost, and SHA-256 of the repaired rows as ``role:text``
    joined by newlines (of nothing: of the empty string).  A digest is read in
    order, so each conversation of several parts ends in one task, which holds
    a part at a time."""
    said = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    one = repaired_parts.where("whole").select("conv_id", "audit", "cost", F.sha2(said.cast("binary"), 256).alias("repaired_sha256"))
    many = (repaired_parts.where("not whole").drop("whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_digests, _DIGEST))
    found = _with(one.unionByName(many), stats, "conv_id").withColumnRenamed("conv_id", "_conv_id")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select(
        "conv_id", *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
