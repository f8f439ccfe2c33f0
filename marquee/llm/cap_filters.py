"""Links between vectors of a label with cosine 0.98 or more, by spherical caps.

A filter is a direction made of one random code word per block of coordinates (a
product code, after a random rotation). Each vector is decoded to the filters
whose directions lie nearest to it: those beyond a threshold of its own, set so
that ``LISTED`` filters of each of ``CODES`` codes exceed it. A threshold common
to all vectors leaves some of them without any filter, as the best inner products
with a product code differ much from vector to vector. The list is found block by
block, keeping the best sums so far; no other direction is looked at.

Vectors that share a filter are compared exactly. Two vectors at the limit share
about 20 of their 48 filters, and none of 4,000 pairs at the limit shared no
filter (measured in the tests' manner, 64 coordinates). The number of directions
follows the number of vectors of the largest label, so that unrelated vectors
rarely meet.

Equal vectors are one class with a count before anything else. Filters that only
one class passes are dropped before any vector moves. A filter with more than
``BLOCK`` classes is compared in pairs of blocks, each a task of its own. What
leaves a comparison is a count per class and a spanning forest, never pairs; a
pair that shares several filters is counted in the smallest.

Defined cases: vectors that are null, zero or hold null or non-finite numbers,
and rows without a label, link with nothing; vectors of different lengths are
not compared; rows with equal ids are vectors of their own; for a null id the
component is that of its links; an empty table gives an empty result; further
columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.components import components
from marquee.llm.shipping import map_batches
from marquee.sources.storage import scratch_path, write_table

LIMIT = 0.98
CODES, LISTED = 6, 8
ALONE = 4  # a vector shares filters with unrelated ones of its label about once in this number of times
WORDS = 48  # code words of a block at most
BLOCK = 512
KEY = "h1 long, h2 long"


@lru_cache(maxsize=8)
def product_codes(dim: int, directions: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Of each code a rotation and the words of its blocks; a code has at least
    so many directions, where the number of coordinates allows it."""
    blocks = min(dim, 4)
    while directions ** (1 / blocks) > WORDS and blocks < dim:
        blocks += 1
    words = max(2, int(np.ceil(directions ** (1 / blocks))))
    rng = np.random.default_rng(20_240_601 + dim)
    codes = []
    for _ in range(CODES):
        rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        parts = [rng.standard_normal((words, len(p))) for p in np.array_split(np.arange(dim), blocks)]
        codes.append((rotation, [p / np.linalg.norm(p, axis=1, keepdims=True) for p in parts]))
    return codes


def decode(unit: np.ndarray, directions: int) -> np.ndarray:
    """Numbers of the filters of each unit vector, ascending in each row."""
    lists = []
    for number, (rotation, words) in enumerate(product_codes(unit.shape[1], directions)):
        rotated = unit @ rotation
        found, sums, at = np.full((len(unit), 1), number, np.int64), np.zeros((len(unit), 1)), 0
        for block in words:
            part = rotated[:, at : at + block.shape[1]] @ block.T
            at += block.shape[1]
            sums = (sums[:, :, None] + part[:, None, :]).reshape(len(unit), -1)
            found = (found[:, :, None] * len(block) + np.arange(len(block))).reshape(len(unit), -1)
            if sums.shape[1] > LISTED:
                best = np.argpartition(-sums, LISTED - 1, axis=1)[:, :LISTED]
                sums, found = np.take_along_axis(sums, best, 1), np.take_along_axis(found, best, 1)
        lists.append(found)
    return np.sort(np.concatenate(lists, axis=1), axis=1)


def _unit(vectors: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(vectors.flatten(), np.float64).reshape(-1, dim)
    # Scaling by the largest part first keeps very large and very small numbers in range.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def groups_of(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, of rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [np.asarray(batch[k]) for k in key]
        change = np.zeros(len(batch) - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(bounds, bounds[1:]):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row of a symmetric matrix of links."""
    n = len(linked)
    roots = np.arange(n)
    while True:
        near = np.minimum(roots, np.where(linked, roots[None, :], n).min(1))
        near = near[near]
        if (near == roots).all():
            return roots
        roots = near


def compare(group: pa.Table, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Of the rows of one filter (or one pair of its blocks): links counted here
    by row, rows, and the row each one hangs on (a spanning forest)."""
    n = len(group)
    if n < 2:
        return None
    own, i, j = group["_filter"][0].as_py(), group["_i"][0].as_py(), group["_j"][0].as_py()
    part = group["_part"].to_numpy()
    x = _unit(group["vector"].combine_chunks(), group["_dim"][0].as_py())
    linked = x @ x.T >= limit
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= part[:, None] != part[None, :]
    if not linked.any():
        return None
    lists = group["filters"].combine_chunks()
    offsets, numbers = np.asarray(lists.offsets), np.asarray(lists.flatten())
    row = np.repeat(np.arange(n), np.diff(offsets))
    earlier = numbers < own
    counted = linked
    if earlier.any():
        distinct, at = np.unique(numbers[earlier], return_inverse=True)
        member = np.zeros((n, len(distinct)), np.float32)
        member[row[earlier], at] = 1
        counted = linked & (member @ member.T < 0.5)
    links = counted @ group["copies"].to_numpy()
    return links, np.arange(n), _roots(linked)


def vector_links(rows: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row."""
    spark = rows.sparkSession
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), "label")
    sound = (
        F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    vectors = vectors.withColumn("_sound", F.coalesce(sound, F.lit(False))).withColumns(
        {f"h{i}": F.when(F.col("_sound"), F.xxhash64(F.lit(i), "vector", "label")) for i in (1, 2)}
    )
    classes = write_table(
        vectors.where("_sound").groupBy("h1", "h2").agg(
            F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
        ),
        scratch_path(spark, "classes"),
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    directions = ALONE * CODES * LISTED**2 * max(largest, 64)

    def filters_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(2).value_lengths())
            found: list[np.ndarray] = [None] * len(batch)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for a in range(0, len(at), 1024):
                    some = at[a : a + 1024]
                    for k, numbers in zip(some, decode(_unit(batch.column(2).take(pa.array(some)), int(dim)), directions)):
                        found[k] = numbers
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(list(map(len, found))))), pa.int32()), pa.array(np.concatenate(found) if found else [], pa.int64())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["h1", "h2", "filters"])

    n_tasks = max(spark.sparkContext.defaultParallelism, 1)
    passed = write_table(
        classes.select("h1", "h2", "vector").repartition(n_tasks).transform(map_batches, filters_of, f"{KEY}, filters array<long>"),
        scratch_path(spark, "filters"),
    )
    with_vectors = classes.select("h1", "h2", "label", "vector", "copies", F.size("vector").alias("_dim"))
    bucket = ["label", "_dim", "_filter"]
    in_filters = passed.join(with_vectors.select("h1", "h2", "label", "_dim"), ["h1", "h2"]).select(
        "h1", "h2", "label", "_dim", F.explode("filters").alias("_filter")
    )
    in_filters = write_table(in_filters, scratch_path(spark, "passed"))
    sizes = in_filters.groupBy(*bucket).count().where("count > 1").select(*bucket, F.ceil(F.col("count") / BLOCK).cast("int").alias("_k"))
    met = in_filters.join(sizes, bucket).withColumn("_part", F.pmod("h1", F.col("_k")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_k") - 1), lambda o: F.struct(F.least("_part", o).alias("_i"), F.greatest("_part", o).alias("_j"))
    )
    met = met.select("h1", "h2", *bucket, "_part", F.inline(pairs))
    full = met.join(with_vectors.drop("label", "_dim"), ["h1", "h2"]).join(passed, ["h1", "h2"])
    key = [*bucket, "_i", "_j"]
    dealt = full.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, key):
            result = compare(group, limit)
            if result is None:
                continue
            links, _, roots = result
            touched = np.flatnonzero((links > 0) | (roots != np.arange(len(roots))))
            h1, h2 = group["h1"].to_numpy(), group["h2"].to_numpy()
            columns = [h1[touched], h2[touched], links[touched].astype(np.int64), h1[roots[touched]], h2[roots[touched]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h1", "h2", "links", "r1", "r2"])

    found = write_table(dealt.transform(map_batches, run, f"{KEY}, links long, r1 long, r2 long"), scratch_path(spark, "links"))
    forest = found.where("h1 != r1 or h2 != r2").select(F.struct("h1", "h2").alias("a"), F.struct(F.col("r1").alias("h1"), F.col("r2").alias("h2")).alias("b"))
    roots = components(forest).select("node.h1", "node.h2", "root")
    counts = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    own = F.struct("h1", "h2")
    joined = classes.join(counts, ["h1", "h2"], "left").join(roots, ["h1", "h2"], "left").select(
        "h1", "h2", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", own).alias("root")
    )
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    result = joined.join(smallest, "root").select("h1", "h2", "n_links", "component_id")
    return vectors.join(result, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
