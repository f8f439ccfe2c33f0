"""Perplexity of documents under a character model of trusted text.

The model is an interpolated modified Kneser-Ney model of order four over real
characters (``character_grams``): sharded count tables of all trusted documents,
joined with the documents' n-grams. The functions here down to ``scored`` are the
same model over 64 classes of characters in one table; tests compare with it, no
query uses it.

A document is kept if its perplexity is at most its language's threshold: a
quantile of the perplexities of that language's trusted documents, times a
margin. Languages without any trusted document use the quantile of all.

Defined cases: null and empty texts have no perplexity and are not kept; a null
language is a language of its own; ids that are null or unlabelled are scored as
all others; repeated rows are scored alike; without any trusted text nothing can
be said and every document with a text is kept; further columns of the input are
carried through by ``scored``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import character_grams
from marquee.llm.shipping import map_batches
from marquee.llm.tokens import groups
from marquee.sources.storage import scratch_path, write_table

ORDER = 4
CLASSES = 64
START, SPACE_CLASS = 0, 1
QUANTILE = 0.995
MARGIN = 1.05
#: Ids of trusted documents up to this number (16 MB) are sent to every task, more are joined by a shuffle.
SENT_IDS = 1_000_000

# Characters of classes 29 to 60, in this order; letters with accents are lower case.
SIGN_CLASSES = (".", ",", ";:", "'’", '"“”„«»', "!?¡¿", "-–—", "()", "[]{}", "/\\", "#*$%&|<>", "+=_~^`@")
ACCENT_CLASSES = ("ß", "à", "á", "âãå", "ä", "æœ", "ç", "è", "é", "êë", "íì", "îï", "ñ", "óò", "ôõø", "ö", "úù", "û", "ü", "ýÿ")


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of each code point below 0x3000, and of all others in the last entry."""
    table = np.full(0x3001, 63, np.uint8)
    table[0x0100:0x0250] = 60  # other Latin letters
    table[0x0370:0x0530] = 61  # Greek and Cyrillic
    table[0x3000] = 62  # ideographs and all else above
    for c in (*range(9, 14), 32, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F):
        table[c] = SPACE_CLASS
    for i in range(26):
        table[ord("a") + i] = 2 + i
    for c in "0123456789":
        table[ord(c)] = 28
    for i, chars in enumerate((*SIGN_CLASSES, *ACCENT_CLASSES)):
        for c in chars:
            table[ord(c)] = 29 + i
    table[0] = START
    return table


def four_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the four-grams of all texts, one per character, and how many
    each text has. Every text begins after three start classes."""
    lowered = [t.lower().replace("\0", " ") for t in texts]
    lead = "\0" * (ORDER - 1)
    points = np.frombuffer((lead + lead.join(lowered)).encode("utf-32-le", "replace"), "<u4")
    classes = class_table()[np.minimum(points, 0x3000)].astype(np.int32)
    lengths = np.array(list(map(len, lowered)), np.int64)
    numbers = classes[3:] + CLASSES * (classes[2:-1] + CLASSES * (classes[1:-2] + CLASSES * classes[:-3]))
    keep = np.ones(len(numbers), bool)
    ends = np.cumsum(lengths + ORDER - 1)[:-1] - (ORDER - 1)  # the last class of a text stands before this place
    for k in range(ORDER - 1):
        keep[ends + k] = False
    return numbers[keep], lengths


def count_four_grams(trusted: DataFrame) -> DataFrame:
    """``gram`` and ``n`` over all rows of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**ORDER, np.int32)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in groups(texts):
                found, n = np.unique(four_grams(texts[a:b])[0], return_counts=True)
                total[found] += n.astype(np.int32)
        found = np.flatnonzero(total)
        for a in range(0, len(found), 100_000):
            some = found[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["gram", "n"])

    return trusted.select("text").transform(map_batches, run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def smoothed(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from one to four: (``gram``, ``part``), the discounted
    share of each n-gram in its context, and (``context``, ``rest``), the weight
    that the context leaves to the order below."""
    tables = [counts]
    for order in range(ORDER - 1, 0, -1):
        # Continuation count: how many classes stand before the n-gram.
        suffix = (F.col("gram") % F.lit(CLASSES**order)).cast("int")
        tables.insert(0, tables[0].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n")))
    result = []
    for table in tables:
        d1, d2, d3 = _discounts(table)
        with_context = table.withColumn("context", F.floor(F.col("gram") / CLASSES).cast("int"))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = with_context.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("left"))
        parts = with_context.join(contexts, "context").select("gram", ((F.col("n") - discount) / F.col("total")).alias("part"))
        result.append((parts, contexts.select("context", (F.col("left") / F.col("total")).alias("rest"))))
    return result


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """Of n-grams seen once, twice and more often, from the numbers of n-grams seen one to four times."""
    row = table.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


class Model:
    """Log probability of each four-gram's last class."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.tables = tables

    @lru_cache(maxsize=1)
    def logs(self) -> np.ndarray:
        below = np.full(1, 1 / CLASSES, np.float32)
        for order, (grams, part, contexts, rest) in enumerate(self.tables, 1):
            weight = np.ones(CLASSES ** (order - 1), np.float32)
            weight[contexts] = rest
            # A context's shorter form is its number without the leading class.
            shorter = below.reshape(-1, CLASSES) if order > 1 else np.full((1, CLASSES), 1 / CLASSES, np.float32)
            level = weight.reshape(-1, len(shorter))[:, :, None] * shorter[None]
            below = level.reshape(-1)
            below[grams] += part
        return np.log(below, out=below)


def train(counts: DataFrame) -> Model | None:
    counts = write_table(counts, scratch_path(counts.sparkSession, "four-grams"))
    if counts.isEmpty():
        return None
    tables = []
    for parts, contexts in smoothed(counts):
        p, c = parts.toArrow(), contexts.toArrow()
        tables.append((p["gram"].to_numpy(), p["part"].to_numpy().astype(np.float32), c["context"].to_numpy(), c["rest"].to_numpy().astype(np.float32)))
    return Model(tables)


def scored(docs: DataFrame, model: Model | None, text: str = "text", name: str = "perplexity") -> DataFrame:
    """All columns of ``docs`` and the perplexity per character of the text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    if model is None:
        return docs.withColumn(name, F.lit(None).cast("double"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = sent.value.logs()
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            values = []
            for a, b in groups(texts):
                grams, lengths = four_grams(texts[a:b])
                sums = np.concatenate(([0.0], np.cumsum(logs[grams], dtype=np.float64)))
                ends = np.cumsum(lengths)
                values.append(np.where(lengths > 0, np.exp(-(sums[ends] - sums[ends - lengths]) / np.maximum(lengths, 1)), np.nan))
            found = np.round(np.concatenate(values), 6) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, from_pandas=True)], names=[*batch.schema.names, name])

    return docs.transform(map_batches, run, schema)


def with_trust(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``_trusted``: labelled as good and not as toxic."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id").distinct()
    good = write_table(good.where("doc_id is not null").withColumn("_trusted", F.lit(True)), scratch_path(docs.sparkSession, "trusted"))
    joined = docs.join(F.broadcast(good) if good.count() <= SENT_IDS else good, "doc_id", "left")
    return joined.select(*[docs[c] for c in docs.columns], F.coalesce("_trusted", F.lit(False)).alias("_trusted"))


def thresholds(trusted: DataFrame) -> DataFrame:
    """``lang`` ('' for none) and ``threshold``; the row with ``lang`` null is for all others."""
    lang = F.coalesce("lang", F.lit(""))
    value = (F.percentile_approx("perplexity", QUANTILE, 10_000) * MARGIN).alias("threshold")
    each = trusted.groupBy(lang.alias("lang")).agg(value)
    return each.unionByName(trusted.agg(value).select(F.lit(None).cast("string").alias("lang"), "threshold"))


def classified(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``perplexity``, ``threshold`` and ``passes``."""
    spark = docs.sparkSession
    marked = with_trust(docs, labels)
    model = character_grams.train(marked.where("_trusted"))
    has_text = (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("_has_text")
    wanted = [F.col(f"`{c}`").alias(f"_out_{i}") for i, c in enumerate(columns)]
    rows = character_grams.scored(marked, model, "_perplexity").select(*wanted, F.col("lang").alias("_lang"), "_trusted", has_text, "_perplexity")
    rows = write_table(rows, scratch_path(spark, "perplexities"))  # texts are scored once
    measured = rows.where("_trusted and _perplexity is not null").select(F.col("_lang").alias("lang"), F.col("_perplexity").alias("perplexity"))
    limits = write_table(thresholds(measured), scratch_path(spark, "thresholds"))
    general = limits.where("lang is null").first()["threshold"]
    each = limits.where("lang is not null")
    joined = rows.join(each, F.coalesce("_lang", F.lit("")) == F.col("lang"), "left")
    limit = F.coalesce("threshold", F.lit(general).cast("double"))
    passes = F.col("_has_text") & F.coalesce(F.col("_perplexity") <= limit, F.lit(True))
    return joined.select(
        *[F.col(f"_out_{i}") for i in range(len(columns))],
        F.col("_perplexity").alias("perplexity"), limit.alias("threshold"), passes.alias("passes"),
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``perplexity``, ``threshold`` and ``kept`` of each row."""
    rows = classified(docs.select("doc_id", "lang", "text"), labels, ["doc_id", "lang"])
    return rows.select(F.col("_out_0").alias("doc_id"), F.col("_out_1").alias("lang"), "perplexity", "threshold", F.col("passes").alias("kept"))


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The input rows that pass, with all their columns."""
    rows = classified(docs, labels, docs.columns).where("passes")
    return rows.select(*[F.col(f"_out_{i}").alias(c) for i, c in enumerate(docs.columns)])
