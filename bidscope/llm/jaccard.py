"""Similarity join on word shingles by T-occurrence search.

Equal shingle sets become one node.  Shingles have one global order, rare
ones first; two sets that link share a known number of the first shingles of
each, so only those first shingles meet in a shuffle.  Sets that share fewer
there link with nothing and are done.

Each other set gets a home, by its first shared shingle; homes have a bounded
weight, and a hot shingle is salted over several.  Every home is searched for
itself.  Where a shingle has several homes their leaders alone are dealt out
again, to the fewer homes that they fill, until that lessens them no more: a
group of near copies is one component then.  Last, each of a set's rarest
shared first shingles that is in several homes and components names one home,
where all sets that have it among their rarest meet: so many of each that two
sets which share as many as a link needs have one of them in common.  So any
two sets that can link have met or are connected, and a set goes to no more
homes than it has such shingles, however many homes there are.
Where more meet than a home holds, those of a shingle's main component, which
look for the others only, and the others are dealt into blocks, and tasks are
pairs of blocks.

A home is searched with inverted lists: the few longest lists are only probed,
the others are merged by a heap, and a set that reaches the required overlap
is checked exactly (DivideSkip).

A home's lists hold leaders only.  A set that links to a leader joins its
ball.  1 - Jaccard is a metric, so a set that links to a member of a ball is
within twice the distance of the leader: the search asks leaders for that
weaker likeness, and looks into the ball of one that answers only if it is
not connected yet.  No link between different sets is lost, and a group of
near copies costs one search for each, not one check for each pair.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.llm import sums
from bidscope.llm.columns import give_back, known_small, require, with_columns
from bidscope.llm.words import shingle_runs, shingles, slices, split_words
from bidscope.session import stage

WORDS = 5                      # in a shingle
LIKE = 80                      # hundredths of the union that two sets share
EACH = 20                      # one shared first shingle is asked for by so many of a set
SLOTS = 1 << 16                # of the table of shingle counts
SHIFT = np.uint64(48)          # of a hash to its slot
HOME = 600_000                 # shingles in a home, about
SKIP = 0.0085                  # weight of a probe against a merge step
ROUNDS = 2                     # in which sets without a chance elsewhere go
HEAP, FEW = 1000, 8            # entries that a heap merges, leaders that are probed one by one


def _links(shared: int, a: int, b: int, like: int) -> bool:
    return 100 * shared >= like * (a + b - shared)


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            runs, whole = shingle_runs(split_words(part.column("text")), WORDS)
            total += np.bincount((runs[whole] >> SHIFT).astype(np.int64), minlength=SLOTS)
    yield sums.parts(total, SLOTS // 16)
    give_back()


def slot_ranks(docs: DataFrame) -> np.ndarray:
    """How far above the mean (in powers of two) the count of a slot of
    shingles is, over all documents.  Any order of shingles gives the same
    links; this one puts very common shingles last."""
    total = sums.total(docs.select("text").mapInArrow(_count_slots, sums.SCHEMA), SLOTS)
    mean = max(total.mean(), 1)
    return np.floor(np.log2(np.maximum(total / mean, 1))).astype(np.uint64)


def ordered_sets(texts: pa.Array, ranks: np.ndarray) -> list[np.ndarray]:
    """Shingle sets as numbers whose order is the global one."""
    return shingles(split_words(texts), WORDS, lambda h: ranks[(h >> SHIFT).astype(np.int64)] << np.uint64(58) | h >> np.uint64(6))


def head_size(n: int, like: int) -> int:
    """First shingles of a set of n that meet: beyond those that a link may
    lack, one for each EACH of the set."""
    return min(n, n - -(-like * n // 100) + -(-n // EACH))


def _asked(n: Column, like: int) -> Column:
    """First shingles that a set of n shares with any set that it links to,
    which has like / 100 of n at least."""
    return F.ceil(F.ceil(n * like / 100) / EACH)


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


class Search:
    """The sets of one home; ``add`` them in ascending order of their size."""

    def __init__(self, like: int = LIKE, known: list[int] | None = None):
        """``known``: what component each set that will be added is of."""
        self.like, self.far = like, max(1, 2 * like - 100)
        self.lists: dict[int, array] = {}
        self.sets: list[np.ndarray] = []
        self.parent: list[int] = []
        self.leaders: list[int] = []                    # sets that lists number 0, 1, ...
        self.balls: list[list[tuple[float, int]]] = []  # their members with their distance
        self.known, self.first_of = known, {}

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def overlapping(self, tokens: list[int], least: int) -> list[tuple[int, int]]:
        """Leaders that share at least ``least`` of the tokens, and how many.

        A leader that does is in the short lists at least ``least`` less the
        number of long ones times, so only these are merged: by a heap, or by
        one sort if they hold very much."""
        lists = [x for x in map(self.lists.get, tokens) if x is not None]
        if len(lists) < least:
            return []
        lists.sort(key=len, reverse=True)
        n_long = min(least - 1, int(least / (SKIP * np.log2(len(lists[0]) + 1) + 1)))
        long, short = lists[:n_long], lists[n_long:]
        if sum(map(len, short)) <= HEAP:
            merged = [(x, sum(1 for _ in run)) for x, run in groupby(heapq.merge(*short))]
            found = [(x, n) for x, n in merged if n >= least - n_long]
        else:
            leaders, counts = np.unique(np.frombuffer(b"".join(short), np.int32), return_counts=True)
            keep = counts >= least - n_long
            found = list(zip(leaders[keep].tolist(), counts[keep].tolist()))
        return self._probe(found, long, least) if len(found) <= FEW else self._probe_many(found, long, least)

    @staticmethod
    def _probe(found: list[tuple[int, int]], long: list[array], least: int) -> list[tuple[int, int]]:
        out = []
        for leader, count in found:
            left = len(long)
            for x in long:
                at = bisect_left(x, leader)
                count += at < len(x) and x[at] == leader
                left -= 1
                if count + left < least:
                    break
            if count >= least:
                out.append((leader, count))
        return out

    @staticmethod
    def _probe_many(found: list[tuple[int, int]], long: list[array], least: int) -> list[tuple[int, int]]:
        leaders, counts = np.array(found, np.int64).T
        for i, x in enumerate(long):
            known = np.frombuffer(x, np.int32)
            at = np.searchsorted(known, leaders)
            at[at == len(known)] = 0
            counts = counts + (known[at] == leaders)
            if i % 32 == 31:
                keep = counts + (len(long) - i - 1) >= least
                leaders, counts = leaders[keep], counts[keep]
        keep = counts >= least
        return list(zip(leaders[keep].tolist(), counts[keep].tolist()))

    def add(self, tokens: np.ndarray) -> None:
        me, n = len(self.sets), len(tokens)
        self.sets.append(tokens)
        self.parent.append(me if self.known is None else self.first_of.setdefault(self.known[me], me))
        names = tokens.tolist()
        best, apart = None, []
        for leader, shared in self.overlapping(names, max(1, -(-self.far * n // 100))):
            size = len(self.sets[self.leaders[leader]])
            distance = 1 - shared / (n + size - shared)
            if _links(shared, n, size, self.like):
                self.parent[self.find(me)] = self.find(self.leaders[leader])
                best = min(best or (distance, leader), (distance, leader))
            elif _links(shared, n, size, self.far):
                apart.append((distance, leader))
        if best is not None:
            self.balls[best[1]].append((best[0], me))
        else:
            for token in names:
                if token in self.lists:
                    self.lists[token].append(len(self.leaders))
                else:
                    self.lists[token] = array("i", (len(self.leaders),))
            self.leaders.append(me)
            self.balls.append([])
        for distance, leader in apart:
            if self.find(me) == self.find(self.leaders[leader]):
                continue
            nearest = distance - (100 - self.like) / 100 - 1e-9
            for theirs, other in self.balls[leader]:
                if theirs >= nearest and self._like(tokens, self.sets[other]):
                    self.parent[self.find(me)] = self.find(other)
                    break

    def _like(self, a: np.ndarray, b: np.ndarray) -> bool:
        if 100 * min(len(a), len(b)) < self.like * max(len(a), len(b)):
            return False
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        return _links(int((b[at] == a).sum()), len(a), len(b), self.like)


FOUND = "node long, root long, leader boolean"


def _search_home(like: int):
    """Of each set that is linked or a leader: the smallest set that it is
    connected to in this home, and whether it is a leader."""
    def run(table: pa.Table) -> pa.Table:
        rows = {}
        for node, raw in zip(table.column("node").to_pylist(), table.column("tokens")):
            rows[node] = np.frombuffer(raw.as_buffer(), np.uint64)
        component = dict(zip(table.column("node").to_pylist(), table.column("component").to_pylist()))
        nodes = sorted(rows, key=lambda x: (len(rows[x]), x))
        search = Search(like, [component[x] for x in nodes])
        for x in nodes:
            search.add(rows[x])
        groups: dict[int, list[int]] = {}
        for i, x in enumerate(nodes):
            groups.setdefault(search.find(i), []).append(x)
        leaders = {nodes[i] for i in search.leaders}
        found = [(x, min(g), x in leaders) for g in groups.values() for x in g if len(g) > 1 or x in leaders]
        del search, rows
        give_back()
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*found)) or [(), (), ()], (pa.int64(), pa.int64(), pa.bool_()))], ["node", "root", "leader"])
    return run


def linked_components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of ``edges`` (node, root): the smallest node
    of the component.  Labels go along edges and then to the label of the
    label, until none changes; each round is written to the shared folder."""
    edges = edges.where("node != root")
    both = edges.union(edges.select("root", "node")).toDF("node", "next").distinct()
    both = stage(both, "edges")
    labels = stage(both.groupBy("node").agg(F.least(F.min("next"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.toDF("next", "l"), "next").groupBy("node").agg(F.min("l").alias("l"))
        moved = labels.join(near, "node").select("node", F.least("label", "l").alias("to"), F.col("label").alias("old"))
        jumped = moved.join(labels.toDF("to", "further"), "to").select("node", F.least("to", "further").alias("label"), "old")
        rounds = stage(jumped, "labels")
        labels = rounds.select("node", "label")
        if rounds.where("label != old").isEmpty():
            return labels


def rarest(at: DataFrame, like: int) -> DataFrame:
    """Of ``at`` (node, n, token, home, component): enough of each set's
    shingles to find all it may link with in other homes and components.

    A shingle counts that is in several homes and components, and a set that
    has as many of those as it must share; without the other sets fewer
    shingles count, so this is done ``ROUNDS`` times.  Of the m that a set has
    left, shingles of few homes first, any other set with as many of them in
    common has one among both sets' first m less those that must be shared,
    and one: the shingles of the most homes are only looked up where a set
    has not enough others."""
    for _ in range(ROUNDS):
        apart = at.groupBy("token").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("home", "component")])
        apart = apart.where("min_home < max_home AND min_component < max_component").select("token")
        at = stage(at.join(apart, "token"), "apart")
        able = at.groupBy("node").agg(F.first("n").alias("n"), F.count("*").alias("shared")).where(F.col("shared") >= _asked(F.col("n"), like))
        at = at.join(known_small(stage(able.select("node"), "able")), "node", "left_semi")
    wide = at.groupBy("token").agg(F.count_distinct("home").alias("wide"))
    own = Window.partitionBy("node")
    placed = at.join(wide, "token").withColumn("place", F.row_number().over(own.orderBy("wide", "token"))).withColumn("m", F.count("*").over(own))
    return stage(placed.where(F.col("place") <= F.col("m") - _asked(F.col("n"), like) + 1).drop("wide", "place", "m"), "rarest")


def places(at: DataFrame) -> DataFrame:
    """(node, home, component, n, is_main): in which homes the sets of ``at``
    (node, n, token, home, component) meet those of other homes and
    components, one at most for each of their shingles.

    All sets of a shingle meet in the home that has most of them.  Sets of its
    main component look for the others only: ``is_main`` are those that need
    no more in a home."""
    def most(c: str) -> DataFrame:
        counted = at.groupBy("token", c).agg(F.count("*").alias("count"))
        return counted.groupBy("token").agg(F.max(F.struct("count", c))[c].alias(f"main_{c}"), F.count("*").alias("parts")).where("parts > 1").drop("parts")

    told = at.join(most("home").join(most("component"), "token"), "token")
    return told.groupBy("node", F.col("main_home").alias("home")).agg(
        F.first("component").alias("component"), F.first("n").alias("n"), F.min(F.col("component") == F.col("main_component")).alias("is_main"))


def tasks_of(places: DataFrame) -> DataFrame:
    """(node, component, home, block) of ``places``: a home's sets are dealt
    into groups of a home's weight, those of main components apart, and every
    two groups are a block, but not two of main components."""
    def groups(main: Column) -> Column:
        return F.ceil(F.sum(F.when(main, F.col("n")).otherwise(0)) / HOME).cast("int")

    sized = places.groupBy("home").agg(groups(~F.col("is_main")).alias("others"), groups(F.col("is_main")).alias("mains"))
    own = F.when(F.col("is_main"), F.col("others") + F.pmod(F.xxhash64("node"), "mains")).otherwise(F.pmod(F.xxhash64("node"), "others"))
    dealt = places.join(sized, "home").withColumn("count", F.col("others") + F.col("mains")).withColumn("own", own.cast("int"))
    met = F.sequence(F.lit(0), F.when(F.col("is_main"), F.col("others")).otherwise(F.col("count")) - 1)
    dealt = dealt.withColumn("other", F.explode(F.filter(met, lambda x: (x != F.col("own")) | (F.col("count") == 1))))
    return dealt.select("node", "component", "home", (F.least("own", "other") * F.col("count") + F.greatest("own", "other")).alias("block"))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", like: int = LIKE) -> DataFrame:
    """For each row of ``docs``: its key, ``n_shingles`` and
    ``component_id``, the smallest key that links reach.

    Two texts link when 100 * shared >= ``like`` * united of their distinct
    5-word shingles (``like`` over 50); a text of fewer words is one shingle.
    Texts without words have none and keep their own key.  Rows with equal
    sets are in one component, whatever their keys; null keys are never the
    smallest unless all are null."""
    require(docs, key, text)
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ranks = slot_ranks(docs)

    def first(part: pa.RecordBatch) -> list:
        found = ordered_sets(part.column("text"), ranks)
        heads = [s[:head_size(len(s), like)] for s in found]
        cuts = np.append(0, np.cumsum([len(h) for h in heads])).astype(np.int32)
        return [pa.array([len(s) for s in found], pa.int64()),
                pa.array([_digest(s) if len(s) else None for s in found], pa.binary()),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([np.empty(0, np.uint64), *heads]).view(np.int64)))]

    sets = stage(with_columns(docs, "text", "n long, digest binary, head array<long>", first, ["key"]), "sets")
    nodes = stage(sets.where("n > 0").groupBy("digest").agg(F.min("key").alias("least"), F.first("n").alias("n"))
                  .withColumn("node", F.monotonically_increasing_id()), "nodes")

    known = known_small(nodes.select("digest", "least", "node"))
    heads = (sets.join(known, (sets.digest == nodes.digest) & sets.key.eqNullSafe(nodes.least))
             .select("node", "n", F.explode("head").alias("token")).repartition("token"))
    common = heads.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("token")
    met = stage(heads.join(common, "token"), "met")

    homes = met.groupBy("node").agg(F.min("token").alias("token"), F.first("n").alias("n"), F.count("*").alias("shared"))
    homes = stage(homes.where(F.col("shared") >= _asked(F.col("n"), like)).drop("shared"), "alive")
    def whole(part: pa.RecordBatch) -> list:
        found = ordered_sets(part.column("text"), ranks)
        return [pa.array([s.tobytes() if _digest(s) == d else None for s, d in zip(found, part.column("digest").to_pylist())], pa.binary())]

    def searched(tasks: DataFrame, name: str) -> DataFrame:
        """(node, root, leader) of ``tasks`` (node, component, home, block)."""
        asked = tasks.groupBy("node").agg(F.first("component").alias("component"), F.collect_list(F.struct("home", "block")).alias("tasks"))
        wanted = known_small(stage(asked.join(nodes.select("node", "digest", "least"), "node"), "wanted"))
        texts = docs.join(wanted, docs.key.eqNullSafe(wanted.least)).select("text", "node", "component", "tasks", "digest")
        placed = (with_columns(texts, "text", "tokens binary", whole, ["node", "component", "tasks", "digest"]).where("tokens is not null")
                  .select("node", "component", "tokens", F.explode("tasks").alias("task")))
        return stage(placed.groupBy("task.home", "task.block").applyInArrow(_search_home(like), FOUND), name)

    def dealt(sets: DataFrame, count: int) -> DataFrame:
        """``sets`` (node, token, n) with a home, and how many their token has."""
        weight = sets.groupBy("token").agg(F.ceil(F.sum("n") / HOME).alias("spread"))
        return sets.join(weight, "token").withColumn("home", F.pmod(F.xxhash64("token", F.pmod(F.xxhash64("node"), "spread")), F.lit(count)))

    n_homes = 1 + (homes.agg(F.sum("n")).first()[0] or 0) // HOME
    homes = stage(dealt(homes, n_homes), "homes")
    alone = [F.col("node").alias("component"), F.lit(0).alias("block")]
    links = searched(homes.select("node", *alone, "home"), "links")
    crowded, leaders = homes.where("spread > 1").select("node", "token", "n"), links
    left = crowded.count()
    while left:
        crowded = stage(crowded.join(leaders.where("leader").select("node").distinct(), "node", "left_semi"), "leaders")
        if 2 * crowded.count() > left:
            break
        left = crowded.count()
        leaders = searched(dealt(crowded, n_homes).select("node", *alone, "home"), "links")
        links = links.unionByName(leaders)
        crowded = dealt(crowded, n_homes).where("spread > 1").select("node", "token", "n")
        left = min(left, crowded.count())
    near = linked_components(links.select("node", "root"))

    component = F.coalesce("label", "node").alias("component")
    homes = stage(homes.join(near, "node", "left").select("node", "n", "home", component), "homes")
    at = rarest(met.join(known_small(homes.drop("n")), "node").select("node", "n", "token", "home", "component"), like)
    meet = stage(places(at), "places")
    late = searched(tasks_of(meet), "late-links").select("node", "root")
    named = near.toDF("node", "a")
    joined = late.join(named, "node", "left").select(F.coalesce("a", "node").alias("node"), "root").join(
        named.toDF("root", "b"), "root", "left").select("node", F.coalesce("b", "root").alias("root"))
    top = linked_components(stage(joined.where("node != root").distinct(), "late-links"))
    every = near.unionByName(top.select("node", F.col("node").alias("label"))).distinct().toDF("node", "label")
    labels = every.join(top.toDF("label", "top"), "label", "left").select("node", F.coalesce("top", "label").alias("label")).distinct()

    named = labels.join(nodes.select("node", "least"), "node")
    smallest = named.groupBy("label").agg(F.min("least").alias("component"))
    classes = nodes.join(labels, "node", "left").join(smallest, "label", "left").select(
        "digest", F.coalesce("component", "least").alias("component"))
    rows = sets.select(F.col("key"), "n", F.col("digest").alias("own"))
    return rows.join(classes, rows.own == classes.digest, "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component")).alias("component_id"))
