"""Prefix trie of conversations, with subtree totals by time-forward processing.

A conversation is a sequence of turns (role, text). Every distinct sequence of
its first ``d`` turns is a node of depth ``d``; the textless root has depth 0 and
every conversation, even one without turns, is a member of it. A node is named
by a pair of 40-bit sums over its turns of hashes of (place, role, text); the sums
come from one running window per conversation, so a node's key and its parent's
key (the sum without the last turn) need no join and no path is ever stored.

Subtree totals (childless nodes, saved characters) go from the deepest nodes to
the root, as in time-forward processing: nodes are sorted in reverse level order
and each passes its running total to its parent. Here the sorted queue is
Spark's window sort. Each node belongs to the path of its smallest member
conversation (its chain); every conversation passes, deepest node first, the
running total of its chain's nodes up its own path, and a node's subtree total
is the sum of what its member conversations passed through it at its depth.
Member ``m`` passes through node ``v`` exactly the nodes of ``m``'s chain at
depth ``v`` or below, and every node of ``v``'s subtree is in the chain of
exactly one member of ``v``: so the sums are exact, with one window per
conversation and one grouping by node, whose partial sums are taken before the
shuffle. No node, however many members or children it has, is one task, and
there are no rounds per level.

Only the list of members that end at a node is not decomposable: its SHA-256 is
taken over ids in ascending order, streamed through a sorted partition, so a
node with many ending members costs time in one task but no memory.

Defined cases: rows with a null conversation id are left out; null role or text
count as empty; turns are ordered by ``turn`` with nulls first, then by role and
text, so that equal turns have one order; repeated rows are separate turns; an
empty table gives no node; long texts only count their characters. Two
different prefixes could share a key with probability about ``nodes^2 / 2^81``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.shipping import map_batches

#: Every conversation takes its first ``crc32(id) % SHARED`` turns from conversation ``id - id % GROUP``.
SHARED, GROUP = 6, 100
MASK = (1 << 40) - 1
KEY = ["depth", "k1", "k2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, turns): ``c`` and ``n_turns`` of every conversation; and its
    rebuilt turns ``c``, ``part`` (0 borrowed, 1 own), ``pos``, ``role``, ``text``."""
    own = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    own = own.withColumn("pos", F.row_number().over(order) - 1).drop("turn")
    shared = (F.crc32(F.col("c").cast("string")) % SHARED).cast("long")
    lengths = own.groupBy("c").agg(F.count("*").alias("own_len")).withColumns({"h": shared, "b": F.col("c") - F.col("c") % GROUP})
    base_len = lengths.select(F.col("c").alias("b"), F.col("own_len").alias("base_len"))
    members = lengths.join(base_len, "b", "left").select(
        "c", "h", "b", (F.least("h", F.coalesce("base_len", F.lit(0))) + F.greatest(F.col("own_len") - F.col("h"), F.lit(0))).alias("n_turns")
    )
    borrowed = (
        members.where("h > 0")
        .select("c", "b", "h")
        .join(own.where(F.col("pos") < SHARED - 1).select(F.col("c").alias("b"), "pos", "role", "text"), "b")
        .where(F.col("pos") < F.col("h"))
        .select("c", F.lit(0).alias("part"), "pos", "role", "text")
    )
    kept = own.where(F.col("pos") >= shared).select("c", F.lit(1).alias("part"), "pos", "role", "text")
    return members.select("c", "n_turns"), borrowed.unionByName(kept)


def memberships(conversations: DataFrame) -> DataFrame:
    """One row per conversation and depth on its path: ``c``, the node's key
    (``depth``, ``k1``, ``k2``), its parent's (``p1``, ``p2``), ``last_len``
    (characters of its last text) and ``is_end`` (the conversation ends there)."""
    members, turns = rebuilt_turns(conversations)
    by_place = Window.partitionBy("c").orderBy("part", "pos")
    running = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.withColumn("depth", F.row_number().over(by_place).cast("long"))
    terms = placed.withColumns(
        {"t1": F.xxhash64(F.lit(1), "depth", "role", "text").bitwiseAND(F.lit(MASK)), "t2": F.xxhash64(F.lit(2), "depth", "role", "text").bitwiseAND(F.lit(MASK))}
    )
    summed = terms.withColumns({"k1": F.sum("t1").over(running), "k2": F.sum("t2").over(running), "n": F.count("*").over(Window.partitionBy("c"))})
    inner = summed.select(
        "c", "depth", "k1", "k2", (F.col("k1") - F.col("t1")).alias("p1"), (F.col("k2") - F.col("t2")).alias("p2"),
        F.length("text").cast("long").alias("last_len"), (F.col("depth") == F.col("n")).alias("is_end"),
    )
    root = members.select(
        "c", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), F.lit(0).cast("long").alias("last_len"), (F.col("n_turns") == 0).alias("is_end"),
    )
    return root.unionByName(inner)


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and id: one SHA-256 of the comma-joined ids per node."""
    out: list[tuple] = []
    current, digest, first = None, None, True
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for depth, k1, k2, c in zip(*cols):
            if (depth, k1, k2) != current:
                if current is not None:
                    out.append((*current, digest.hexdigest()))
                current, digest, first = (depth, k1, k2), hashlib.sha256(), True
            digest.update((b"" if first else b",") + str(c).encode())
            first = False
        if len(out) >= 4096:
            yield _hash_batch(out)
            out = []
    if current is not None:
        out.append((*current, digest.hexdigest()))
    if out:
        yield _hash_batch(out)


def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
        names=[*KEY, "ends_sha256"],
    )


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``, plus its key."""
    path = memberships(conversations)
    nodes = path.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("c").alias("conv_id"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("last_len").alias("last_len")
    )
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    own = nodes.select(
        F.col("conv_id").alias("c"), "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("v_leaf"), ((F.col("n_convs") - 1) * F.col("last_len")).alias("v_saved")
    )
    # Time-forward: deepest first, each conversation passes its chain's running totals up its path.
    upward = Window.partitionBy("c").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = path.join(own, ["c", "depth"], "left").select(
        *KEY, F.sum(F.coalesce("v_leaf", F.lit(0))).over(upward).alias("a_leaf"), F.sum(F.coalesce("v_saved", F.lit(0))).over(upward).alias("a_saved")
    )
    totals = passed.groupBy(*KEY).agg(F.sum("a_leaf").cast("long").alias("n_leaves"), F.sum("a_saved").cast("long").alias("saved_tokens"))
    ends = (
        path.where("is_end")
        .select(*KEY, "c")
        .repartition(*KEY)
        .sortWithinPartitions(*KEY, "c")
        .transform(map_batches, _end_hashes, "depth long, k1 long, k2 long, ends_sha256 string")
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    with_parent = nodes.join(parents, ["depth", "p1", "p2"], "left")
    return with_parent.join(totals, KEY).join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), *KEY[1:],
    )


def trie_report(conversations: DataFrame) -> DataFrame:
    """The contract's columns."""
    return trie(conversations).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
