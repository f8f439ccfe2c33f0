"""Top-k, hit records and their JSON form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.scoring import SCORE_DECIMALS
from marquee.functions.urls import TITLE_BASE, with_prefix
from marquee.operators.postings import DOC_BUCKET_BITS, STORED_FIELDS, doc_bucket
from marquee.sources.storage import scratch_path, write_table

# More id folders than this are not named one by one in a scan.
MAX_FOLDERS = 1000

# Spark limits groups before a shuffle up to this rank (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
QUERY_PARTS = 64

HIT_FIELDS = ("score", *STORED_FIELDS)
_DENSE_TEXT = ("score", "year", "rating", "votes", "runtime")


def top_k(matches: DataFrame, k: int = 5, decimals: int = SCORE_DECIMALS) -> DataFrame:
    """The k best rows with a 1-based ``rank``; equal scores go by ``doc_id``.

    Each task keeps k rows, so only k rows per task leave the executors.
    """
    best = (
        matches.withColumn("score", F.round("score", decimals))
        .orderBy(F.desc("score"), "doc_id")
        .limit(k)
    )
    order = Window.orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(order))


def top_k_per_query(
    matches: DataFrame, k: int = 5, query: str = "qid", decimals: int = SCORE_DECIMALS
) -> DataFrame:
    """The k best rows of each query.

    A query that matches most rows must not be sorted in one task. Up to a
    thousand, Spark keeps k rows per query and task before it shuffles; for
    larger k the rows of a query are first ranked in parts by document, so that
    the last step sorts k rows of each part.
    """
    rows = matches.withColumn("score", F.round("score", decimals))
    best_first = (F.desc("score"), F.col("doc_id"))
    if k > GROUP_LIMIT:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(QUERY_PARTS)).alias("_part")
        inside = Window.partitionBy(query, "_part").orderBy(*best_first)
        rows = rows.select("*", part).withColumn("_rank", F.row_number().over(inside)).filter(F.col("_rank") <= k).drop("_part", "_rank")
    order = Window.partitionBy(query).orderBy(*best_first)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def fetch(hits: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored fields for hits.

    The hits are written first: they are then computed once, their size is known
    to the join, and the folders of ids they fall in can be named in the scan
    (unless they are so many that most of the table is read anyway).
    """
    spark = hits.sparkSession
    keyed = write_table(
        hits.withColumn("doc_bucket", doc_bucket(F.col("doc_id"))), scratch_path(spark, "hits")
    )
    folders = keyed.select("doc_bucket").distinct().limit(MAX_FOLDERS + 1).collect()
    if len(folders) <= MAX_FOLDERS:
        stored = stored.filter(F.col("doc_bucket").isin(*[r[0] for r in folders]))
    return keyed.join(stored, ["doc_bucket", "doc_id"]).drop("doc_bucket")


def fetch_known(hits: DataFrame, stored: DataFrame) -> DataFrame:
    """``fetch`` for one short hit list. The list is run first; its ids then go
    into the scan as constants, which skips all row groups without a hit."""
    known = hits.select("rank", "doc_id", "score").toArrow()
    local = hits.sparkSession.createDataFrame(known)
    ids = known["doc_id"].to_pylist()
    buckets = {i >> DOC_BUCKET_BITS for i in ids}
    rows = stored.filter(F.col("doc_bucket").isin(*buckets) & F.col("doc_id").isin(*ids))
    return rows.join(F.broadcast(local), "doc_id").drop("doc_bucket")


def hit_records(hits: DataFrame, extra: tuple[str, ...] = ("rank",), stringify: bool = False) -> DataFrame:
    """The thirteen hit columns; ``stringify`` turns the numbers into text."""
    columns = [
        F.col(c).cast("string") if stringify and c in _DENSE_TEXT else F.col(c)
        for c in HIT_FIELDS
    ]
    return hits.select(*extra, *columns)


def result_cards(hits: DataFrame) -> DataFrame:
    """What a result card shows."""
    return hits.select(
        "rank",
        with_prefix(TITLE_BASE, F.col("movie_id")).alias("title_url"),
        F.col("movie_url").alias("poster_url"),
        "name", "score", "director", "year", "rating",
    )
