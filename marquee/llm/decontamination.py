"""Benchmark decontamination by one Aho-Corasick automaton.

Texts are normalised the same way on both sides: A-Z become a-z and words are the
runs of digits, lower-case letters and characters beyond ASCII. Every run of
``WINDOW`` consecutive words of a benchmark item is a pattern (an item of fewer
words, but at least one, is one pattern of all its words). Patterns are written
as ``" w1 w2 ... wk "`` and documents as ``" " + words joined by one space + " "``,
so that a character match is exactly a match of whole consecutive words. One
automaton over all patterns scans each document once; every match marks the
words it covers, and covered words are mapped back to character offsets of the
original text.

The patterns are the only thing sent to tasks. Their size is measured before
they are gathered; beyond ``BLOCK_BYTES`` they are dealt into blocks by hash,
each block is one automaton and one scan of the documents, and the per-document
results of the blocks are merged by a grouping on the row.

Defined cases: a null or empty text has no words and no hits; null item texts
give no pattern; an item with a null id still marks words but is not listed;
repeated benchmark rows and windows that several items share give one pattern
with all their ids; repeated documents give one row each; an empty benchmark
marks nothing; very long texts are scanned whole. The input row is carried as
the struct ``doc``, so that its column names never clash with the results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.shipping import map_batches
from marquee.sources.storage import scratch_path, write_table

# Fixed values of the task: words, lower-casing, window length.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10

#: Bytes of pattern text in one automaton.
BLOCK_BYTES = 8 << 20

_WORD = re.compile(WORD)
_LOWER = str.maketrans(UPPER, LOWER)
_automata: dict[tuple, object] = {}


def item_windows(benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """``window`` (words joined by one space), ``k`` (its words) and ``item_ids``."""
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.array_join(F.slice("words", i, WINDOW), " "))).when(
        n > 0, F.array(F.array_join("words", " "))
    ).otherwise(F.array().cast("array<string>"))
    return (
        benchmark.select(F.col(item).cast("long").alias("item_id"), words.alias("words"))
        .select("item_id", F.explode(windows).alias("window"))
        .groupBy("window")
        .agg(F.array_sort(F.array_distinct(F.collect_list("item_id"))).alias("item_ids"))
        .withColumn("k", F.size(F.split("window", " ")))
    )


def _automaton(key: tuple, patterns: list[tuple[str, int, list[int]]]):
    import ahocorasick

    if not patterns:  # a block that hashing left empty
        return None
    found = _automata.get(key)
    if found is None:
        found = ahocorasick.Automaton()
        for window, k, items in patterns:
            found.add_word(f" {window} ", (k, tuple(items)))
        found.make_automaton()
        _automata.clear()
        _automata[key] = found
    return found


def scan_text(text: str | None, automaton) -> tuple[int, list[tuple[int, int, int, int]], list[int]]:
    """(words, runs of hit words as (first word, last word, start, end) with
    [start, end) code-point offsets of the original text, sorted ids of items
    with a match)."""
    starts, ends, words = [], [], []
    for m in _WORD.finditer((text or "").translate(_LOWER)):
        starts.append(m.start())
        ends.append(m.end())
        words.append(m.group())
    if not words or automaton is None:
        return len(words), [], []
    lengths = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    at = np.concatenate(([1], 1 + np.cumsum(lengths)[:-1]))  # place of each word in the normalised text
    cover = np.zeros(len(words) + 1, np.int64)
    items: set[int] = set()
    for end, (k, ids) in automaton.iter(" " + " ".join(words) + " "):
        last = int(np.searchsorted(at, end - 1, side="right")) - 1
        cover[last - k + 1] += 1
        cover[last + 1] -= 1
        items.update(i for i in ids if i is not None)
    hit = np.cumsum(cover[:-1]) > 0
    return len(words), [(a, b, starts[a], ends[b]) for a, b in _hit_runs(hit)], sorted(items)


def _hit_runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


RUNS = "array<struct<a:long,b:long,start:long,end:long>>"
_RUN = pa.struct([(n, pa.int64()) for n in ("a", "b", "start", "end")])


def _scan_batches(batches: Iterator[pa.RecordBatch], key: tuple, patterns, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Column 0 passes through; column 1 is the text."""
    automaton = _automaton(key, patterns.value) if patterns is not None else None
    for batch in batches:
        found = [scan_text(t, automaton) for t in batch.column(1).to_pylist()]
        runs = [[dict(zip(("a", "b", "start", "end"), r)) for r in f[1]] for f in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array([f[2] for f in found], pa.list_(pa.int64()))],
            names=names,
        )


def _scans(rows: DataFrame, windows: DataFrame, block_bytes: int) -> list[DataFrame]:
    """One scan of ``rows`` (a carried column and ``_text``) per block of patterns."""
    spark = rows.sparkSession
    names = [rows.columns[0], "n_words", "runs", "item_ids"]
    schema = T.StructType([rows.schema[0], *T._parse_datatype_string(f"n_words long, runs {RUNS}, item_ids array<long>").fields])
    sizes = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("window") + 2), F.lit(0)).alias("bytes")).first()
    if sizes["n"] == 0:
        return [rows.transform(map_batches, partial(_scan_batches, key=("none",), patterns=None, names=names), schema)]
    blocks = max(1, -(-int(sizes["bytes"]) // block_bytes))
    scans = []
    for block in range(blocks):
        chosen = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else windows
        patterns = [(r["window"], r["k"], list(r["item_ids"])) for r in chosen.collect()]
        shared = spark.sparkContext.broadcast(patterns)
        key = (spark.sparkContext.applicationId, block, blocks, len(patterns), hash(tuple(p[0] for p in patterns[:100])))
        scans.append(rows.transform(map_batches, partial(_scan_batches, key=key, patterns=shared, names=names), schema))
    return scans


def _merged_runs(runs: F.Column) -> F.Column:
    """Sorted runs of word places, overlapping or touching ones joined."""

    def step(acc: F.Column, x: F.Column) -> F.Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"), last["start"].alias("start"), F.when(x["b"] > last["b"], x["end"]).otherwise(last["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (x["a"] <= last["b"] + 1), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(runs), F.array().cast(RUNS), step)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc`` (the input row), ``n_words``, ``n_hit``
    (words inside an occurrence of a window), ``spans`` (runs of hit words as
    [start, end) code-point offsets of the original text) and ``item_ids``
    (non-null ids of items with an occurring window, ascending)."""
    windows = item_windows(benchmark, item_text)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").cast("string").alias("_text"))
    first = _scans(rows, windows, block_bytes)
    if len(first) > 1:  # rows get ids that stay fixed, as several scans must agree on them
        spark = docs.sparkSession
        numbered = write_table(rows.withColumn("_row", F.monotonically_increasing_id()), scratch_path(spark, "decontamination-rows"))
        parts = _scans(numbered.select("_row", "_text"), windows, block_bytes)
        found = (
            _union(parts)
        ).groupBy("_row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
        scanned = numbered.select("_row", "doc").join(found, "_row").drop("_row")
    else:
        scanned = first[0]
    runs = _merged_runs(F.col("runs"))
    return scanned.select(
        "doc",
        "n_words",
        F.aggregate(runs, F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"] + 1).alias("n_hit"),
        F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("spans"),
        "item_ids",
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def decontamination_report(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The digest of each document: doc_id, n_words, n_hit, n_items,
    items_sha256 (item ids sorted as strings, comma-joined) and contaminated."""
    found = contamination(docs, benchmark, block_bytes=block_bytes)
    return found.select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
