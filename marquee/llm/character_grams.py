"""Modified Kneser-Ney over n-grams of real characters, in sharded tables.

An n-gram of up to four characters is one number of 84 bits in two longs ``a``
and ``b`` (21 bits each: code point + 2, 1 before the start of a text, 0 for no
character), so keys are exact in every script and tables grow with the text that
is counted. No table is collected or broadcast by hand.

Documents are dealt into blocks of about ``BLOCK_CHARS`` characters. A block's
distinct n-grams are joined with the model and come back to the block, where
its documents are summed up; nothing is written per document and n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.cap_filters import groups_of
from marquee.llm.shipping import map_batches, ship
from marquee.llm.tokens import groups
from marquee.sources.storage import scratch_path, write_table

ORDER = 4
BITS = 21
MASK = (1 << BITS) - 1
START = 1
#: Characters that may come next: all code points.
ALPHABET = 0x110000
BLOCK_CHARS = 16_000_000
KEY = ["a", "b"]


def pairs_of(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pairs of neighbouring characters of all texts, each after three start
    signs, and which pairs end a four-gram (all whose second is no start sign)."""
    lead = "\0" * (ORDER - 1)
    points = np.frombuffer((lead + lead.join(texts)).encode("utf-32-le", "replace"), "<u4").astype(np.int64) + 2
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + ORDER - 1
    begins = np.cumsum(sizes) - sizes
    for k in range(ORDER - 1):
        points[begins + k] = START
    return pa.array(points[:-1] << BITS | points[1:]).dictionary_encode(), points[ORDER - 1 :] != START


def four_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """``a`` and ``b`` of the distinct four-grams of all texts, and for each group
    of texts the place of every character's four-gram there and the texts' lengths."""
    found = [(*pairs_of(texts[i:j]), np.fromiter(map(len, texts[i:j]), np.int64, j - i)) for i, j in groups(texts)]
    every = np.unique(np.concatenate([p.dictionary.to_numpy() for p, _, _ in found])) if found else np.zeros(0, np.int64)
    # Each form of a group's characters goes as the next one is made, so that a block is held once.
    coded = []
    while found:
        pairs, ends, lengths = found.pop()
        at = np.searchsorted(every, pairs.dictionary.to_numpy())[pairs.indices.to_numpy()]
        coded.append((pa.array((at[:-2] << 32 | at[2:])[ends]).dictionary_encode(), lengths))
    grams = np.unique(np.concatenate([g.dictionary.to_numpy() for g, _ in coded])) if coded else np.zeros(0, np.int64)
    places = []
    while coded:  # from the end again: in the order of the texts
        codes, lengths = coded.pop()
        places.append((np.searchsorted(grams, codes.dictionary.to_numpy()).astype(np.int32)[codes.indices.to_numpy()], lengths))
    return every[grams >> 32], every[grams & 0xFFFFFFFF], places


def keys_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys that the four-grams need, and their places by rows:
    the n-grams of order four to one, then their contexts of order three to one."""
    middle, none = (a & MASK) << BITS | b >> BITS, np.zeros_like(a)
    every = np.concatenate([a, a & MASK, none, none, a >> BITS, none, none])
    rest = np.concatenate([b, b, b, b & MASK, middle, middle, b >> BITS])
    order = np.lexsort((rest, every))
    x, y = every[order], rest[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    places = np.empty(len(x), np.int64)
    places[order] = np.cumsum(new) - 1
    return x[new], y[new], places.reshape(7, -1)


def counted(trusted: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``n`` of the four-grams of all rows of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, places = four_grams([t or "" for t in batch.column(0).to_pylist()])
            n = sum((np.bincount(at, minlength=len(a)) for at, _ in places), np.zeros(len(a), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    return trusted.select("text").transform(map_batches, run, "a long, b long, n long").groupBy(*KEY).agg(F.sum("n").alias("n"))


def _suffix(order: int) -> list:
    """Key of an n-gram of this order without its first character."""
    a = F.col("a").bitwiseAND(F.lit(MASK)) if order == 4 else F.lit(0).cast("long")
    return [a.alias("a"), (F.col("b").bitwiseAND(F.lit(MASK)) if order == 2 else F.col("b")).alias("b")]


def _context() -> list:
    """Key of an n-gram without its last character."""
    low = F.shiftleft(F.col("a").bitwiseAND(F.lit(MASK)), BITS).bitwiseOR(F.shiftright("b", BITS))
    return [F.shiftright("a", BITS).alias("ca"), low.alias("cb")]


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """Of n-grams seen once, twice and more often, from the numbers of n-grams seen one to four times."""
    row = table.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def train(trusted: DataFrame) -> tuple[DataFrame, float] | None:
    """The table ``a``, ``b``, ``p`` (probability of an n-gram's last character)
    and ``rest`` (what an n-gram as a context leaves to shorter ones), and the
    probability of a character never seen; None without any text."""
    spark = trusted.sparkSession
    levels = [write_table(counted(trusted), scratch_path(spark, "grams-4"))]
    if levels[0].isEmpty():
        return None
    for order in range(ORDER, 1, -1):
        shorter = levels[0].select(*_suffix(order)).groupBy(*KEY).agg(F.count("*").alias("n"))
        levels.insert(0, write_table(shorter, scratch_path(spark, f"grams-{order - 1}")))
    known = unseen = below = None
    for order, level in enumerate(levels, 1):
        d1, d2, d3 = discounts(level)
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        rows = level.select(*KEY, *_context(), "n", discount.alias("d"))
        contexts = rows.groupBy("ca", "cb").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("rest"))
        part = (F.col("n") - F.col("d")) / F.col("total")
        if order == 1:
            unseen = contexts.first()["rest"] / ALPHABET
            level_p = rows.crossJoin(F.broadcast(contexts.select("total"))).select(*KEY, (part + unseen).alias("p"))
        else:
            suffix = [c.alias(f"s{k}") for c, k in zip(_suffix(order), KEY)]
            shorter = below.select(F.col("a").alias("sa"), F.col("b").alias("sb"), F.col("p").alias("q"))
            joined = rows.select("*", *suffix).join(contexts, ["ca", "cb"]).join(shorter, ["sa", "sb"])
            level_p = joined.select(*KEY, (part + F.col("rest") * F.col("q")).alias("p"))
        below = write_table(level_p, scratch_path(spark, f"shares-{order}"))
        both = below.withColumn("rest", F.lit(None).cast("double"))
        if order > 1:
            both = both.unionByName(contexts.select(F.col("ca").alias("a"), F.col("cb").alias("b"), F.lit(None).cast("double").alias("p"), "rest"))
        known = both if known is None else known.unionByName(both)
    model = known.groupBy(*KEY).agg(F.max("p").alias("p"), F.max("rest").alias("rest"))
    return write_table(model, scratch_path(spark, "character-model")), unseen


def scored(docs: DataFrame, model: tuple[DataFrame, float] | None, name: str = "perplexity", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All columns of ``docs`` and the perplexity per character of ``text``; null for none."""
    if model is None:
        return docs.withColumn(name, F.lit(None).cast("double"))
    table, unseen = model
    ship(docs.sparkSession)
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(-(-chars // block_chars), 1)
    columns, at = docs.columns, docs.columns.index("text")
    # Rows of one text are spread by what else they have.
    block = F.pmod(F.xxhash64("text", *[c for c in ("doc_id", "lang") if c in columns]), F.lit(blocks)).cast("int")
    # One shuffle of the texts serves both sides below: all columns stay in both.
    dealt = docs.withColumn("_block", block).repartition("_block").sortWithinPartitions("_block")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["_block"]):
            a, b, _ = keys_of(*four_grams([t or "" for t in group.column(at).to_pylist()])[:2])
            number = np.full(len(a), group["_block"][0].as_py(), np.int32)
            for i in range(0, len(a), 100_000):
                j = min(i + 100_000, len(a))
                place = np.arange(i, j, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (number[i:j], place, a[i:j], b[i:j])], names=["_block", "place", "a", "b"])

    def measure(rows: pa.Table, found: pa.Table) -> pa.Table:
        texts = [t or "" for t in rows.column(at).to_pylist()]
        a, b, groups_ = four_grams(texts)
        x, _, places = keys_of(a, b)
        p, rest = np.full(len(x), np.nan), np.full(len(x), np.nan)
        p[found["place"].to_numpy()] = found["p"].to_numpy()
        rest[found["place"].to_numpy()] = found["rest"].to_numpy()
        value = np.full(len(a), unseen)
        for order in range(1, ORDER + 1):
            if order > 1:
                weight = rest[places[2 * ORDER - order]]
                value = np.where(np.isnan(weight), 1.0, weight) * value
            own = p[places[ORDER - order]]
            value = np.where(np.isnan(own), value, own)
        logs, values = np.log(value), [np.zeros(0)]
        for at_, lengths in groups_:
            sums, ends = np.concatenate(([0.0], np.cumsum(logs[at_]))), np.cumsum(lengths)
            values.append(np.where(lengths > 0, np.exp(-(sums[ends] - sums[ends - lengths]) / np.maximum(lengths, 1)), np.nan))
        result = pa.array(np.round(np.concatenate(values), 6), from_pandas=True)
        return pa.Table.from_arrays([*(rows.column(i) for i in range(len(columns))), result], names=[*columns, name])

    found = dealt.transform(map_batches, keys, "_block int, place int, a long, b long").join(table, KEY).select("_block", "place", "p", "rest")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return dealt.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(measure, schema)
