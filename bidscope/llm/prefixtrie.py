"""Trie of conversation prefixes, rolled up by centroid decomposition.

A node is a distinct sequence of first turns.  Its key is its depth and the
exclusive or of 128-bit hashes of (place, turn), which can be summed in blocks
of turns, so that no conversation has to lie in one task.  A node is named by
(smallest member, depth): along a conversation's path the nodes of which it is
the smallest member are one chain down to its end, so that only a chain's top
has to look its parent up.

Sums over subtrees: the number of (member, turn) pairs from a node on is its
weight, known without any rollup.  Nodes that are connected and have the same
quotient of weight by ``piece`` are a piece: where it is 0 a whole subtree,
else a path, and never more than ``piece`` nodes.  Pieces are rolled up in
tasks, many in each: the centroid of a component is removed, the total of what
lies below it is added on the path from it to the component's top, and the
components that are left are split in turn.  The pieces themselves are a tree,
those that are paths at most 3 * weight / piece, rolled up alike in between.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.llm.columns import arrow_schema, require
from bidscope.session import stage

PIECE = 50_000                  # nodes of a piece, or the square root of the whole weight if that is more
BUCKET = 100_000                # nodes that one task rolls up, in any number of pieces
BLOCK = 4096                    # turns in a block of a conversation
SALTS = 64                      # tasks that look up the same key


def number_turns(conversations: DataFrame) -> DataFrame:
    """Turns of (conv_id, turn, role, text) with their place from 1 on and
    the number of turns: conv_id, size, depth, said (digest of role and text),
    bytes (of the text).  In order of turn, null ones first, those of one turn
    by digest; a null role or text is empty; rows without conv_id are left
    out.  Range partitions of (conv_id, turn) are numbered by themselves."""
    require(conversations, "conv_id", "turn", "role", "text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat_ws(":", F.length(role), role, text).cast("binary"))).alias("said"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("tie"))
    ranged = turns.repartitionByRange("conv_id", "turn", "said", "tie").drop("tie")
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv_id")             # a row for each task that has some of a conversation
    sizes = ranged.groupBy("conv_id", "part").count().select(
        "conv_id", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"), F.sum("count").over(every).alias("size"))
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "said"))
    numbered = ranged.withColumn("place", place).join(sizes, ["conv_id", "part"]).select(
        "conv_id", "part", "size", (F.col("place") + F.col("offset")).alias("depth"), "said", "bytes")
    return stage(numbered, "numbered-turns")


def rebuild(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Every conversation c begins with the first crc32(c) % most turns of
    conversation c - c % family and goes on with its own turns after as many.
    Turns as from ``number_turns``, and (conv_id, size) of every conversation,
    0 for those without turns."""
    parts = turns.select("conv_id", "part", "size").distinct()
    lengths = parts.select("conv_id", "size").distinct()
    plan = lengths.select("conv_id", "size", (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
                          (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("head"))
    plan = plan.withColumn("head", F.when(F.col("conv_id") == F.col("base"), 0).otherwise(F.col("head")))
    plan = plan.join(lengths.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size")), "base", "left")
    plan = plan.withColumn("taken", F.least("head", F.coalesce("base_size", F.lit(0))))
    plan = plan.withColumn("whole", F.col("taken") + F.greatest(F.col("size") - F.col("head"), F.lit(0)))
    plan = stage(plan.select("conv_id", "base", "head", "taken", "whole"), "rebuilt-conversations")
    own = turns.drop("size").join(parts.drop("size").join(plan, "conv_id"), ["conv_id", "part"]).where("depth > head")
    own = own.select("conv_id", F.col("whole").alias("size"), (F.col("depth") - F.col("head") + F.col("taken")).alias("depth"), "said", "bytes")
    heads = turns.where(f"conv_id % {family} = 0 AND depth < {most}").select(F.col("conv_id").alias("base"), "depth", "said", "bytes")
    lent = plan.where("taken > 0").join(heads, "base").where("depth <= taken").select("conv_id", F.col("whole").alias("size"), "depth", "said", "bytes")
    return own.unionByName(lent), plan.select("conv_id", F.col("whole").alias("size"))


def members(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns with the key (depth, k1, k2) of the node that they end in, and
    what they alone add to it (l1, l2)."""
    lanes = turns.withColumn("l1", F.xxhash64("depth", "said")).withColumn("l2", F.xxhash64(F.lit(7), "said", "depth"))
    lanes = lanes.withColumn("block", F.floor((F.col("depth") - 1) / block))
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = lanes.where(F.col("size") > block).groupBy("conv_id", "block").agg(F.bit_xor("l1").alias("t1"), F.bit_xor("l2").alias("t2"))
    carried = totals.select("conv_id", "block", F.bit_xor("t1").over(ahead).alias("c1"), F.bit_xor("t2").over(ahead).alias("c2"))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = lanes.withColumn("x1", F.bit_xor("l1").over(inside)).withColumn("x2", F.bit_xor("l2").over(inside))
    whole = lambda x, c: F.col(x).bitwiseXOR(F.coalesce(F.col(c), F.lit(0).cast("long")))
    return own.join(carried, ["conv_id", "block"], "left").select(
        "conv_id", "size", "depth", whole("x1", "c1").alias("k1"), whole("x2", "c2").alias("k2"), "l1", "l2", "bytes")


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Inner join with a table that has each key once, where very many rows
    may ask for the same key: they ask in SALTS groups."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    answers = salted.select(*keys, "_salt").distinct().join(table, keys)
    return salted.join(answers, [*keys, "_salt"]).drop("_salt")


def roll_up(up: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums over subtrees of a forest by centroid decomposition.  ``up`` is
    each node's parent or -1; ``values`` are lists to be summed, each apart."""
    n = len(up)
    below: list[list[int]] = [[] for _ in range(n)]
    for v, u in enumerate(up):
        if u >= 0:
            below[u].append(v)
    gone, size = [False] * n, [1] * n
    out = [[0] * n for _ in values]
    tops = [v for v in range(n) if up[v] < 0]
    while tops:
        top = tops.pop()
        nodes = [top]
        for v in nodes:
            size[v] = 1
            nodes += [w for w in below[v] if not gone[w]]
        for v in reversed(nodes):
            if v != top:
                size[up[v]] += size[v]
        centre = top
        while True:
            heavy = next((w for w in below[centre] if not gone[w] and 2 * size[w] > len(nodes)), None)
            if heavy is None:
                break
            centre = heavy
        under = [centre]
        for v in under:
            under += [w for w in below[v] if not gone[w]]
        for value, sums in zip(values, out):
            total, v = sum(value[w] for w in under), centre
            while True:
                sums[v] += total
                if v == top:
                    break
                v = up[v]
        gone[centre] = True
        tops += [w for w in below[centre] if not gone[w]]
        if centre != top:
            tops.append(top)
    return out


def _roll_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rolls up the pieces of a bucket; a node whose parent is of another
    piece is its piece's top."""
    table = pa.Table.from_batches(list(batches))
    a, b, ua, ub, piece, q, leaves, saved = [table.column(c).to_pylist() for c in ("a", "b", "up_a", "up_b", "piece", "q", "leaves", "saved")]
    at = {key: i for i, key in enumerate(zip(a, b))}
    up = [at.get(key, -1) for key in zip(ua, ub)]
    up = [u if u >= 0 and piece[u] == piece[i] and q[u] == q[i] else -1 for i, u in enumerate(up)]
    leaves, saved = roll_up(up, [leaves, saved])
    yield pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(ua, pa.int64()), pa.array(ub, pa.int64()), pa.array([u < 0 for u in up]),
         pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], schema=arrow_schema(_ROLLED))


_ROLLED = "a long, b long, up_a long, up_b long, top boolean, leaves long, saved long"


def _rolled(nodes: DataFrame, buckets: int) -> DataFrame:
    return nodes.groupBy(F.pmod(F.xxhash64("piece", "q"), F.lit(buckets))).applyInArrow(_roll_bucket, _ROLLED)


def _given_up(rolled: DataFrame) -> DataFrame:
    """What the tops of pieces add to the nodes that they hang from."""
    return rolled.where("top AND up_a IS NOT NULL").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))


def _add(nodes: DataFrame, more: DataFrame) -> DataFrame:
    plus = lambda c: (F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c)
    return nodes.join(more, ["a", "b"], "left").select("a", "b", "up_a", "up_b", "piece", "q", plus("leaves"), plus("saved"))


def _linked(tops: DataFrame) -> DataFrame:
    """(conv_id, q, piece): the chain in which the piece of a chain's top
    begins, where that is another chain.  Each round doubles how far up a
    chain has looked."""
    links = stage(tops.where("q = up_q").select("conv_id", "q", F.col("parent_conv_id").alias("piece")), "links")
    while True:
        further = links.select(F.col("conv_id").alias("piece"), "q", F.col("piece").alias("beyond"))
        links = stage(links.join(further, ["piece", "q"], "left"), "links")
        done = links.where("beyond IS NOT NULL").isEmpty()
        links = links.select("conv_id", "q", F.coalesce("beyond", "piece").alias("piece"))
        if done:
            return links


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's sorted conv_ids, as they pass."""
    schema, node, hashed, out = arrow_schema(_ENDS), None, None, []
    for batch in batches:
        for *key, conv in zip(*[c.to_pylist() for c in batch.columns]):
            if key != node:
                if node is not None:
                    out.append((*node, hashed.hexdigest()))
                node, hashed = key, hashlib.sha256(str(conv).encode())
            else:
                hashed.update(f",{conv}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*node, hashed.hexdigest()), schema)], schema=schema)


_ENDS = "depth long, k1 long, k2 long, ends_sha256 string"


def trie(turns: DataFrame, conversations: DataFrame, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """The trie of ``turns`` (conv_id, size, depth, said, bytes; depth from 1
    to size without gaps) of all ``conversations`` (conv_id, size, once each).

    One row a node, the root (depth 0) included if there is a conversation:
    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id;
    root: null), n_convs, n_children, n_leaves, saved_tokens (summed over the
    subtree: members beyond the first times bytes of the last text) and
    ends_sha256 (of the conv_ids of members that end here, ascending, joined
    by commas).  Equal conversations are members of the same nodes; any number
    of them costs one pre-aggregated row a task.  The ids of conversations
    that end in the same node are hashed in order, so by one task, which holds
    a batch of them."""
    spread = stage(members(turns, block), "trie-members")
    size_after = lambda c: F.col("size") - c + 1
    nodes = spread.groupBy("depth", "k1", "k2").agg(
        F.min(F.struct("conv_id", "size")).alias("head"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.sum(size_after(F.col("depth"))).alias("weight"), F.max("l1").alias("l1"), F.max("l2").alias("l2"))
    root = conversations.agg(F.min(F.struct("conv_id", "size")).alias("head"), F.count("*").alias("n_convs"), F.sum(size_after(F.lit(0))).alias("weight"))
    zero = lambda *names: [F.lit(0).cast("long").alias(c) for c in names]
    root = root.where("n_convs > 0").select("*", *zero("depth", "k1", "k2", "bytes", "l1", "l2"))
    nodes = stage(nodes.unionByName(root).select(
        F.col("head.conv_id").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(F.col("l1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("l2")).alias("p2"), "n_convs", "bytes", "weight", (F.col("head.size") > F.col("depth")).alias("goes_on")), "trie-nodes")

    # Chains: where each begins, and the node it hangs from.
    begin = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "p1", "p2", "weight")).alias("top")).where("top.depth > 0").select(
        "conv_id", (F.col("top.depth") - 1).alias("depth"), F.col("top.p1").alias("k1"), F.col("top.p2").alias("k2"), F.col("top.weight").alias("weight"))
    parents = nodes.select(F.col("conv_id").alias("parent_conv_id"), "depth", "k1", "k2", F.col("weight").alias("up_weight"))
    tops = stage(look_up(begin, parents, ["depth", "k1", "k2"], "conv_id"), "trie-chains")

    total = nodes.agg(F.count("*").alias("n"), F.max("weight").alias("weight")).first()
    most, buckets = max(piece, math.isqrt(total.weight or 0) + 1), 1 + total.n // BUCKET
    quotient = lambda c: F.floor(F.col(c) / F.lit(most)).cast("long")
    hanging = tops.groupBy(F.col("parent_conv_id").alias("conv_id"), "depth").agg(F.count("*").alias("hanging"))
    above = tops.select("conv_id", (F.col("depth") + 1).alias("depth"), "parent_conv_id")
    full = nodes.join(hanging, ["conv_id", "depth"], "left").join(above, ["conv_id", "depth"], "left")
    children: Column = F.coalesce("hanging", F.lit(0)) + F.col("goes_on").cast("long")
    full = full.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"), "n_convs",
        children.alias("n_children"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), quotient("weight").alias("q"), "k1", "k2")
    links = _linked(tops.select("conv_id", "parent_conv_id", quotient("weight").alias("q"), quotient("up_weight").alias("up_q")))
    full = stage(full.join(links, ["conv_id", "q"], "left").withColumn("piece", F.coalesce("piece", "conv_id")), "trie-pieces")

    ready = full.select(F.col("conv_id").alias("a"), F.col("depth").alias("b"), F.col("parent_conv_id").alias("up_a"),
                        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("up_b"), "piece", "q",
                        (F.col("n_children") == 0).cast("long").alias("leaves"), "saved")
    rolled = stage(_rolled(ready.where("q = 0"), buckets), "trie-subtrees")
    if (total.weight or 0) >= most:
        paths = stage(_add(ready.where("q > 0"), _given_up(rolled)), "trie-paths")
        tops_of = paths.groupBy("piece", "q").agg(F.min(F.struct("b", "up_a", "up_b")).alias("top"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        home = paths.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("piece").alias("up_piece"), F.col("q").alias("up_q"))
        forest = tops_of.select("piece", "q", "leaves", "saved", "top.up_a", "top.up_b").join(home, ["up_a", "up_b"], "left")
        tree = forest.select(F.col("piece").alias("a"), F.col("q").alias("b"), F.col("up_piece").alias("up_a"), F.col("up_q").alias("up_b"),
                             F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("q"), "leaves", "saved")
        sums = _rolled(tree, 1).select(F.col("a").alias("piece"), F.col("b").alias("q"), "leaves", "saved", F.lit(True).alias("top"))
        handed = _given_up(forest.drop("leaves", "saved").join(sums, ["piece", "q"]))
        rolled = rolled.unionByName(_rolled(_add(paths, handed), buckets))

    gone = spread.where("depth = size").select(F.col("depth").cast("long").alias("depth"), "k1", "k2", "conv_id")
    gone = gone.unionByName(conversations.where("size = 0").select(*zero("depth", "k1", "k2"), "conv_id"))
    key = ["depth", "k1", "k2"]
    ends = gone.repartition(*key).sortWithinPartitions(*key, "conv_id").mapInArrow(_ends, _ENDS)
    sums = rolled.select(F.col("a").alias("conv_id"), F.col("b").alias("depth"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return full.join(sums, ["conv_id", "depth"]).join(ends, key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
