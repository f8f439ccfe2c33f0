"""Index builds: catalog file or table in, index tables out."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.functions.vectors import Encoder, HashedEncoder, embed
from marquee.operators.cleaning import clean_values
from marquee.operators.dedup import distinct_rows, keep_first_dealt
from marquee.operators.postings import analyze, id_slice, slice_tasks
from marquee.operators.snippet import snippet
from marquee.sources import dense_index
from marquee.sources.catalog import read_catalog_csv, write_catalog
from marquee.sources.index_tables import write_index
from marquee.sources.storage import joins_where_dealt
from marquee.sources.vectors import write_vectors

KINDS = ("lexical", "dense")


def _raw(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    return read_catalog_csv(spark, source) if isinstance(source, str) else source


def _report(seen: Observation, started: float) -> dict:
    return {"docs": seen.get["docs"], "seconds": time.time() - started}


def build_lexical(spark: SparkSession, source: str | DataFrame, out: str, strict: bool = False, fuzzy_keys: bool = False) -> dict:
    """Clean, analyse and write the lexical index; returns documents and seconds.

    ``source`` is a CSV path or a raw table with a unique ``row_ord``, which
    becomes the document id. The count is taken on the way and is for display.
    """
    started, seen = time.time(), Observation("lexical build")
    # ``clean_catalog``, with the rows dealt into slices of ids before they are cleaned.
    rows = keep_first_dealt(_raw(spark, source), ["movie_id"], "row_ord", id_slice(F.col("row_ord")), slice_tasks(spark))
    analyzed = analyze(clean_values(rows, strict), dealt=True)
    with joins_where_dealt(spark):
        write_index(analyzed.observe(seen, F.count(F.lit(1)).alias("docs")), f"{out}/lexical", fuzzy_keys)
    return _report(seen, started)


def _dense_part(spark: SparkSession, source: str | DataFrame, out: str, encoder: Encoder | None, seen: Observation) -> str:
    """Write the deduplicated raw rows and one vector per row as a new part."""
    rows = distinct_rows(_raw(spark, source), "row_ord").withColumnRenamed("row_ord", "doc_id")
    root = f"{out}/dense"
    name = f"part-{uuid.uuid4().hex}"
    catalog = write_catalog(rows.observe(seen, F.count(F.lit(1)).alias("docs")), f"{root}/parts/{name}/catalog")
    write_vectors(encode_catalog(catalog, encoder or HashedEncoder()), f"{root}/parts/{name}/vectors")
    return name


def build_dense(
    spark: SparkSession, source: str | DataFrame, out: str, encoder: Encoder | None = None
) -> dict:
    """Write the deduplicated raw catalog and one vector per row of it as the
    only part of a new snapshot; the old snapshot stays readable until then."""
    started, seen = time.time(), Observation("dense build")
    before, _ = dense_index.latest(spark, f"{out}/dense")
    part = _dense_part(spark, source, out, encoder, seen)
    dense_index.commit(spark, f"{out}/dense", [part], before)
    return _report(seen, started)


def append_dense(
    spark: SparkSession, source: str | DataFrame, out: str, encoder: Encoder | None = None
) -> dict:
    """Add records (``row_ord`` their ids) to the dense index: catalog rows and
    vectors go into a new part, and a snapshot of the old parts and the new one
    is committed last. Ids that the index already holds are refused before
    anything is written."""
    started, seen = time.time(), Observation("dense append")
    root = f"{out}/dense"
    before, parts = dense_index.latest(spark, root)
    if parts:
        _, catalog = dense_index.open_dense(spark, root)
        new_ids = distinct_rows(_raw(spark, source), "row_ord").select(F.col("row_ord").alias("doc_id"))
        if new_ids.join(catalog.select("doc_id"), "doc_id", "left_semi").limit(1).count():
            raise ValueError("appended records must have ids that the index does not hold")
    part = _dense_part(spark, source, out, encoder, seen)
    dense_index.commit(spark, root, [*parts, part], before)
    return _report(seen, started)


def encode_catalog(catalog: DataFrame, encoder: Encoder) -> DataFrame:
    """(doc_id, embedding) of each record's paragraph.

    Encoding is heavy per row and its input is small, so the rows are spread
    over all tasks rather than left in as few as their bytes would need.
    """
    spark = catalog.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = catalog.select("doc_id", snippet().alias("text")).repartition(tasks, "doc_id")
    return texts.select("doc_id", embed(F.col("text"), encoder).alias("embedding"))


def build(
    spark: SparkSession,
    source: str | DataFrame,
    out: str,
    which: set[str] | tuple[str, ...] = KINDS,
    encoder: Encoder | None = None,
) -> dict[str, dict]:
    """Build one or both indexes under ``out``."""
    unknown = set(which) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown index kinds: {sorted(unknown)}")
    reports = {}
    if "lexical" in which:
        reports["lexical"] = build_lexical(spark, source, out)
    if "dense" in which:
        reports["dense"] = build_dense(spark, source, out, encoder)
    return reports
