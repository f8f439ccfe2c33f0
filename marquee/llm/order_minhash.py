"""Near-duplicate documents by Order MinHash and banded alignment.

A k-mer is five consecutive words (lower case, split at white space) labelled
with how often it occurred before in the text. A sketch takes the ``TAKEN``
smallest k-mers under one hash function and keeps them in the order of the text,
so that it is sensitive to what is said where, as an edit distance is. Texts that
agree in one of ``SKETCHES`` sketches are candidates: at similarity 0.8 two texts
have no sketch in common with probability (1 - 0.8^5)^32 = 3e-6. Very short
texts, of which five k-mers would be nearly all, have sketches of two k-mers.

Candidates form families: the connected texts over common sketches. A family is
dealt in pairs of blocks of at most ``BLOCK`` texts, each a task of its own.
There the common k-mers of all pairs are counted by a matrix product, which gives
the highest similarity that any alignment can reach; pairs that reach 0.8 and
are not yet connected are aligned, within the band that this similarity leaves,
and linked if the aligned k-mers are 0.8 or more of all k-mers of both. A
spanning forest of the links leaves the task, never pairs.

Equal texts are one node with a count from the beginning.

Defined cases: null text counts as empty; texts of one to five words are one
k-mer, which is their key: they are linked if their words are equal; texts
without words have no k-mer and are linked only if they are equal; rows with equal ids are documents of their own in
counts; the class of documents without ids is null unless linked to one with an
id; an empty table gives an empty result; ``kept_rows`` keeps one row of a class
whatever repeats, with all its columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.cap_filters import groups_of
from marquee.llm.components import components
from marquee.llm.shipping import emptied_between, map_batches
from marquee.sources.storage import scratch_path, write_table

WORDS = 5
LIMIT = 0.8
SKETCHES, TAKEN = 32, 5
SHORT_SKETCHES, SHORT_TAKEN = 16, 2
#: Texts of up to SHORT_MOST k-mers have short sketches, those of LONG_LEAST or more have long ones: two
#: texts with a similarity of 0.8 have one kind in common whatever their lengths.
LONG_LEAST, SHORT_MOST = 9, 12
BLOCK = 512
COLUMNS = 8_192
MAX_WORDS = 100_000
KEY = ["h1", "h2"]


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        self[word] = value
        return value


_hashes = WordHashes()
emptied_between(_hashes.clear)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers (the finishing steps of a well-known hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def k_mers(text: str) -> np.ndarray:
    """Hashes of the runs of five words in order; of all words if there are fewer."""
    words = text.lower().split()
    if len(_hashes) > MAX_WORDS:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - WORDS + 1, 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(h))):
        total = mixed(total * np.uint64(31) + h[k : k + n])
    return total


def labelled(mers: np.ndarray) -> np.ndarray:
    """Each k-mer together with the number of equal ones before it."""
    order = np.argsort(mers, kind="stable")
    same = mers[order]
    new = np.ones(len(same), bool)
    new[1:] = same[1:] != same[:-1]
    if new.all():
        return mers
    at = np.arange(len(same))
    earlier = np.empty(len(same), np.uint64)
    earlier[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return np.where(earlier > 0, mixed(mers + earlier * np.uint64(0x9E3779B97F4A7C15)), mers)


def sketches(mers: np.ndarray, seeds: np.ndarray, taken: int) -> np.ndarray:
    """One number per seed: the ``taken`` smallest k-mers in text order."""
    result = np.empty(len(seeds), np.uint64)
    step = max(1, 2_000_000 // max(len(mers), 1))
    for a in range(0, len(seeds), step):
        hashed = (mers[None, :] ^ seeds[a : a + step, None]) * np.uint64(0xFF51AFD7ED558CCD)
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xC4CEB9FE1A85EC53)
        if len(mers) > taken:
            places = np.sort(np.argpartition(hashed, taken - 1, axis=1)[:, :taken], axis=1)
        else:
            places = np.broadcast_to(np.arange(len(mers)), hashed.shape)
        total = seeds[a : a + step].copy()
        for k in range(places.shape[1]):
            total = mixed(total * np.uint64(31) + mers[places[:, k]])
        result[a : a + step] = total
    return result


_single = np.uint64(0x9E3779B97F4A7C15)
_seeds = mixed(np.arange(1, SKETCHES + SHORT_SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def keys_of(text: str) -> np.ndarray:
    """All sketches of a text; its k-mer if it has only one, and none without words."""
    mers = labelled(k_mers(text))
    if len(mers) == 1:
        return mixed(mers ^ _single) if text.split() else mers[:0]
    found = []
    if len(mers) >= LONG_LEAST:
        found.append(sketches(mers, _seeds[:SKETCHES], TAKEN))
    if 2 <= len(mers) <= SHORT_MOST:
        found.append(sketches(mers, _seeds[SKETCHES:], SHORT_TAKEN))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def aligned(a: np.ndarray, b: np.ndarray, limit: float) -> float:
    """Share of the k-mers of both that a best alignment in the band matches.

    The band is what ``limit`` allows: with ``need`` matches, at most
    ``len(a) - need`` k-mers of ``a`` and ``len(b) - need`` of ``b`` are passed
    over, so no match lies further from the diagonal.
    """
    n, m = len(a), len(b)
    need = int(np.ceil(limit * (n + m) / (1 + limit) - 1e-9))
    if need > min(n, m):
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    front = int(differ[0]) if len(differ) else short
    differ = np.flatnonzero(a[n - short + front :][::-1] != b[m - short + front :][::-1]) if front < short else differ
    back = (int(differ[0]) if len(differ) else short - front) if front < short else 0
    left, right = a[front : n - back].tolist(), b[front : m - back].tolist()
    where: dict[int, int] = {}
    for j, x in enumerate(right):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(right)) - 1
    below, width = n - need, (n - need) + (m - need) + 1
    band = (1 << width) - 1
    v = full
    for i, x in enumerate(left):
        hit = where.get(x)
        if hit:
            hit &= v & (band << i - below if i >= below else band >> below - i)
            v = (v + hit | v - hit) & full
    matched = front + back + len(right) - v.bit_count()
    return matched / (n + m - matched)


def forest(mers: list[np.ndarray], side: np.ndarray, limit: float = LIMIT) -> list[tuple[int, int]]:
    """Links that connect all linked texts; ``side`` keeps texts of one block apart
    if there are two."""
    n = len(mers)
    sets = [np.sort(labelled(m)) for m in mers]
    sizes = np.array(list(map(len, sets)))
    row = np.repeat(np.arange(n), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, (a, a + COLUMNS))
        part = np.zeros((n, min(COLUMNS, int(column[-1]) + 1 - a)), np.float32)
        part[row[lo:hi], column[lo:hi] - a] = 1
        common += part @ part.T
    best = common / (sizes[:, None] + sizes[None, :] - common)
    i, j = np.nonzero(np.triu(best >= limit - 1e-6, 1) & ((side[:, None] != side[None, :]) if side.any() and not side.all() else True))
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for x, y in sorted(zip(i.tolist(), j.tolist()), key=lambda p: -best[p]):
        rx, ry = root(x), root(y)
        if rx != ry and aligned(mers[x], mers[y], limit) >= limit:
            parent[rx] = ry
            links.append((x, y))
    return links


def with_keys(docs: DataFrame) -> DataFrame:
    """Adds ``h1`` and ``h2``, together the identity of a text."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"h1": F.xxhash64(text, F.lit(1)), "h2": F.xxhash64(F.lit(2), text)})


def _texts(docs: DataFrame) -> DataFrame:
    """One row per text with its sketches, its smallest id and its number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [keys_of(t or "").view(np.int64) for t in batch.column(3).to_pylist()]
            lists = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["h1", "h2", "doc_id", "keys"])

    rows = with_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(*KEY, "doc_id", "text")
    mapped = rows.transform(map_batches, run, "h1 long, h2 long, doc_id long, keys array<long>")
    return mapped.groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), F.any_value("keys").alias("keys"))


def classes(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``h1``, ``h2``, ``first`` (smallest id of the text), ``class_id`` and
    ``class_size`` (rows) of each text."""
    spark = docs.sparkSession
    texts = write_table(_texts(docs), scratch_path(spark, "texts"))
    own = F.struct(*KEY)
    met = texts.select(own.alias("text"), F.explode("keys").alias("key"))
    hubs = met.groupBy("key").agg(F.min("text").alias("hub"), F.count("*").alias("c")).where("c > 1").select("key", "hub")
    # A text is linked to its smallest hub alone, and that to its other hubs: what
    # is connected stays so, and a family has about one link a text.
    hubs_of = met.join(hubs, "key").where("text != hub").groupBy("text").agg(F.collect_set("hub").alias("hubs"))
    least = F.array_min("hubs")
    ends = F.transform("hubs", lambda h: F.when(h == least, F.col("text")).otherwise(h))
    near = hubs_of.select(least.alias("hub"), F.explode(ends).alias("text"))
    families = write_table(
        components(near, "text", "hub").select("node.h1", "node.h2", F.col("root.h1").alias("f1"), F.col("root.h2").alias("f2")),
        scratch_path(spark, "families"),
    )
    sizes = families.groupBy("f1", "f2").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_k"))
    members = families.join(sizes, ["f1", "f2"]).join(texts.select(*KEY, "first"), KEY).withColumn("_part", F.pmod("h1", F.col("_k")).cast("int"))
    # The id is part of the key, which spreads the copies of a text that has very many.
    rows = with_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    here = rows.alias("d").join(
        members.alias("m"), (F.col("d.h1") == F.col("m.h1")) & (F.col("d.h2") == F.col("m.h2")) & F.col("d.doc_id").eqNullSafe(F.col("m.first"))
    ).select("m.h1", "m.h2", "f1", "f2", "_part", "_k", "text")
    others = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda o: F.struct(F.least("_part", o).alias("_i"), F.greatest("_part", o).alias("_j")))
    key = ["f1", "f2", "_i", "_j"]
    dealt = here.select("h1", "h2", "f1", "f2", "_part", "text", F.inline(others)).repartition(*key).sortWithinPartitions(*key, *KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, key):
            h1, h2, part = (group[c].to_numpy() for c in ("h1", "h2", "_part"))
            once = np.ones(len(h1), bool)  # equal rows with equal ids
            once[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            at = np.flatnonzero(once)
            mers = [k_mers(t or "") for t in group["text"].take(pa.array(at)).to_pylist()]
            links = forest(mers, part[at] != group["_i"][0].as_py(), limit) if len(at) > 1 else []
            if links:
                x, y = at[np.array(links).T]
                columns = [h1[x], h2[x], h1[y], h2[y]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a1", "a2", "b1", "b2"])

    found = write_table(dealt.transform(map_batches, run, "a1 long, a2 long, b1 long, b2 long"), scratch_path(spark, "near"))
    pair = lambda a, b: F.struct(F.col(a).alias("h1"), F.col(b).alias("h2"))
    roots = components(found.select(pair("a1", "a2").alias("a"), pair("b1", "b2").alias("b"))).select("node.h1", "node.h2", "root")
    rooted = texts.join(roots, KEY, "left").select(*KEY, "first", "n", F.coalesce("root", own).alias("root"))
    totals = rooted.groupBy("root").agg(
        F.min("first").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct(F.col("first").isNull(), "first", *KEY)).alias("best")
    )
    result = rooted.join(totals, "root").select(
        *KEY, "first", "class_id", "class_size", (F.col("best.h1") == F.col("h1")).alias("_same1"), (F.col("best.h2") == F.col("h2")).alias("_same2")
    )
    return write_table(
        result.withColumn("leads", F.col("_same1") & F.col("_same2")).drop("_same1", "_same2"), scratch_path(spark, "classes")
    )


def judged(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of the class), ``class_size`` and ``kept`` of each row."""
    rows = with_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
    joined = rows.join(classes(docs, limit).drop("first"), KEY, "left")
    return joined.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def kept_rows(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """One row of each class, with all its columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = with_keys(rows).drop("text")
    leaders = classes(docs, limit).where("leads").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first")
    kept = rows.join(
        leaders, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & F.col("doc_id").eqNullSafe(F.col("first")), "left_semi"
    )
    return kept.dropDuplicates([*KEY, "doc_id"]).select("row.*")
