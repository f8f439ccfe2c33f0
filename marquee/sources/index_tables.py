"""The lexical index as Parquet tables.

``docs``      stored fields and lengths, in folders of consecutive ids
``points``    the numbers of each document alone, for numeric clauses
``postings``  blocks of consecutive documents, in folders by field and term bucket, sorted by term then document
``terms``     document frequencies, same folders
``deletions`` each term's strings with one or two characters deleted, for fuzzy lookups
``ranges``    per term of more documents than a range has ids, and range of consecutive ids: bounds of its scores (rows of one range count together)
``fields``    one row per text field: counts, mean length, bucket number, range bits

A build writes them into a folder of its own and adds that folder's name to the
table ``versions`` last, so a build that fails leaves the index as it was, and
searches that are running keep their files.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import scoring
from marquee.operators import postings as P
from marquee.sources.storage import heavy_splits, partition_size, write_in_order, write_sorted

DOCS_PER_TERM_BUCKET = 50_000
MAX_TERM_BUCKETS = 4096
# Rough shuffled size of a posting, to size its files when there are few.
BYTES_PER_TOKEN = 8

_STORED_TYPES = {"year": "int", "rating": "float", "votes": "int", "runtime": "int"}
DOCS_SCHEMA = ", ".join(
    [
        "doc_id long",
        *(f"`{c}` {_STORED_TYPES.get(c, 'string')}" for c in P.STORED_FIELDS),
        *(f"len_{f} int" for f in (*P.TEXT_FIELDS, P.BODY)),
        "doc_bucket long",
    ]
)
POSTINGS_SCHEMA = P.BLOCKS_SCHEMA + ", term_bucket int"
TERMS_SCHEMA = "term string, df long, max_tf int, min_dl int, field string, term_bucket int"
POINTS_SCHEMA = "doc_id long, " + ", ".join(f"`{c}` {_STORED_TYPES[c]}" for c in P.NUMERIC_FIELDS)
VERSIONS_SCHEMA = "version string, built_at long"
DELETIONS_SCHEMA = "key string, term string, field string, term_bucket int"
RANGES_SCHEMA = "term string, doc_range long, n long, max_tf int, min_dl int, max_part double, field string, term_bucket int"
FIELDS_SCHEMA = "field string, n_docs long, avg_len double, buckets int, range_bits int"


@dataclass(frozen=True)
class LexicalIndex:
    docs: DataFrame
    points: DataFrame
    postings: DataFrame
    terms: DataFrame
    fields: dict[str, tuple[int, float]]
    buckets: int
    ranges: DataFrame | None = None
    deletions: DataFrame | None = None
    range_bits: int = 0
    k1: float = scoring.K1
    b: float = scoring.B
    norms: str = "exact"

    @property
    def stored(self) -> DataFrame:
        return self.docs.select("doc_bucket", "doc_id", *P.STORED_FIELDS)

    def with_scoring(self, **settings) -> LexicalIndex:
        """The same tables scored with other ``k1``, ``b`` or ``norms``."""
        return replace(self, **settings)


def write_index(analyzed: DataFrame, path: str, fuzzy_keys: bool = False) -> None:
    """Create or replace the index from analysed documents. ``fuzzy_keys`` adds
    the table of deletion keys, with which fuzzy clauses look up candidate terms
    instead of testing the whole vocabulary (it costs the build the most time).

    Each table is written before the next one is derived from it, so a lost
    executor costs one stage and not the whole chain.
    """
    spark, version = analyzed.sparkSession, f"version-{uuid.uuid4().hex}"
    index, path = path, f"{path}/{version}"
    kept = analyzed.select([c for c in analyzed.columns if not c.startswith("tokens_")])
    docs = write_in_order(kept, f"{path}/docs", ["doc_bucket"])
    docs.select("doc_id", *P.NUMERIC_FIELDS).write.parquet(f"{path}/points")
    stats = P.field_stats(docs).collect()
    n_docs = max((r["n_docs"] for r in stats), default=0)
    n_tokens = sum(int(r["n_docs"] * r["avg_len"]) for r in stats)
    buckets = min(MAX_TERM_BUCKETS, 1 + n_docs // DOCS_PER_TERM_BUCKET)
    bucket = P.term_bucket(F.col("term"), buckets)
    folders = ["field", "term_bucket"]
    with partition_size(spark, n_tokens * BYTES_PER_TOKEN), heavy_splits(spark):
        blocks = P.posting_blocks(docs).withColumn("term_bucket", bucket).hint("rebalance", "term_bucket")
        blocks = write_in_order(blocks.sortWithinPartitions("term", "from_id"), f"{path}/postings", folders)
    write_sorted(
        P.term_stats(P.block_counts(blocks)).withColumn("term_bucket", bucket), f"{path}/terms", folders, ["term"]
    )
    bits = P.range_bits_for(n_docs)
    # At most the postings of the corpus by the ids of a range, so few enough to broadcast.
    common = spark.read.schema(TERMS_SCHEMA).parquet(f"{path}/terms").filter(F.col("df") > F.lit(1 << bits))
    wanted = blocks.join(F.broadcast(common.select(*folders, "term")), [*folders, "term"], "left_semi")
    ranges = P.range_stats(wanted, bits, {r["field"]: r["avg_len"] for r in stats})
    write_in_order(ranges, f"{path}/ranges", folders)
    if fuzzy_keys:
        terms = spark.read.schema(TERMS_SCHEMA).parquet(f"{path}/terms")
        write_sorted(
            P.deletions(terms).withColumn("term_bucket", P.term_bucket(F.col("key"), buckets)), f"{path}/deletions", folders, ["key"]
        )
    fields = spark.createDataFrame([(*r, buckets, bits) for r in stats], FIELDS_SCHEMA)
    fields.coalesce(1).write.mode("overwrite").parquet(f"{path}/fields")
    # One row per build; the last one counts.
    added = spark.createDataFrame([(version, time.time_ns())], VERSIONS_SCHEMA)
    added.coalesce(1).write.mode("append").parquet(f"{index}/versions")


def _optional(spark: SparkSession, schema: str, path: str) -> DataFrame | None:
    """A table that a build may leave out."""
    try:
        table = spark.read.schema(schema).parquet(path)
        table.limit(0).collect()  # the folder exists
        return table
    except AnalysisException:
        return None


def open_index(spark: SparkSession, path: str, **settings) -> LexicalIndex:
    """Read the tables; only the last version's name and the few rows of ``fields`` come to the driver."""
    versions = spark.read.schema(VERSIONS_SCHEMA).parquet(f"{path}/versions")
    path = f"{path}/{versions.orderBy(F.desc('built_at')).first()['version']}"
    stats = spark.read.schema(FIELDS_SCHEMA).parquet(f"{path}/fields").collect()
    return LexicalIndex(
        docs=spark.read.schema(DOCS_SCHEMA).parquet(f"{path}/docs"),
        points=spark.read.schema(POINTS_SCHEMA).parquet(f"{path}/points"),
        postings=P.open_blocks(spark.read.schema(POSTINGS_SCHEMA).parquet(f"{path}/postings")),
        terms=spark.read.schema(TERMS_SCHEMA).parquet(f"{path}/terms"),
        ranges=spark.read.schema(RANGES_SCHEMA).parquet(f"{path}/ranges"),
        deletions=_optional(spark, DELETIONS_SCHEMA, f"{path}/deletions"),
        range_bits=max((r["range_bits"] for r in stats), default=0),
        fields={r["field"]: (r["n_docs"], r["avg_len"]) for r in stats},
        buckets=max((r["buckets"] for r in stats), default=1),
        **settings,
    )
