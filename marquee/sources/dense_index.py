"""The dense index: parts of catalog rows and vectors, named by snapshots.

``parts/<name>/catalog``  catalog rows of one build or append, in id folders
``parts/<name>/vectors``  their vectors
``snapshots``             one row per committed state: its number and its parts

A build or an append writes its part first and then one row of ``snapshots``
naming all parts of the new state. Readers take the highest snapshot and read
exactly its parts, so a build or append that fails half-way leaves the index as
it was, and a search that is running keeps its files. Catalog rows and vectors
of a part are written by the same call, so an appended record is found by a
search and also fetched with its fields.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.catalog import read_catalog, write_catalog
from marquee.sources.vectors import read_vectors, write_vectors

SNAPSHOTS_SCHEMA = "snapshot long, built_at long, parts array<string>"


def latest(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """The number and parts of the last committed snapshot; (0, []) if none."""
    try:
        rows = spark.read.schema(SNAPSHOTS_SCHEMA).parquet(f"{root}/snapshots")
        last = rows.orderBy(F.desc("snapshot")).first()
    except AnalysisException:  # no snapshot written yet
        return 0, []
    return (last["snapshot"], list(last["parts"])) if last else (0, [])


def write_part(rows: DataFrame, vectors: DataFrame, root: str) -> str:
    """Write catalog rows (with ``doc_id``) and their vectors as a new part."""
    name = f"part-{uuid.uuid4().hex}"
    write_catalog(rows, f"{root}/parts/{name}/catalog")
    write_vectors(vectors, f"{root}/parts/{name}/vectors")
    return name


def commit(spark: SparkSession, root: str, parts: list[str], after: int) -> int:
    """Add the snapshot that follows ``after``; the last step of a build."""
    snapshot = after + 1
    row = spark.createDataFrame([(snapshot, time.time_ns(), parts)], SNAPSHOTS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/snapshots")
    return snapshot


def open_dense(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(vectors, catalog) of the last snapshot."""
    _, parts = latest(spark, root)
    if not parts:
        raise FileNotFoundError(f"no dense index under {root}")
    vectors = [read_vectors(spark, f"{root}/parts/{p}/vectors") for p in parts]
    catalogs = [read_catalog(spark, f"{root}/parts/{p}/catalog") for p in parts]
    return _union(vectors), _union(catalogs)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
