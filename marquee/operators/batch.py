"""BM25 top-k for a table of free-text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import scoring
from marquee.functions.text import tokenize
from marquee.operators.matching import field_saturation, stored_length
from marquee.operators.postings import BODY, term_bucket
from marquee.operators.topk import top_k_per_query
from marquee.sources.index_tables import LexicalIndex
from marquee.sources.storage import scratch_path, write_table

# The first estimate of a query's k-th score is taken from its weightiest words,
# enough of them to be found in this many documents per result wanted, or in
# this part of the corpus if that is more.
SEED_DOCS_PER_HIT = 200
SEED_SHARE = 1 / 50

# With this many matches of query words or fewer, scoring them all takes less
# time than finding out which can be left out.
PLAIN_MATCHES = 20_000_000


def query_words(index: LexicalIndex, queries: DataFrame, field: str) -> DataFrame:
    """(qid, term, factor, bound): each query word found in the vocabulary, its
    weight, and the most it can add to the score of any document."""
    n_docs, avg_len = index.fields[field]
    words = (
        queries.select("qid", F.explode_outer(tokenize(F.col("text"))).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("qid", "term")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("term_bucket", term_bucket(F.col("term"), index.buckets))
    )
    shortest = index.terms.filter(F.col("field") == field).withColumnRenamed("min_dl", "dl")
    most = scoring.saturation(
        F.col("max_tf"), stored_length(index), F.lit(avg_len), index.k1, index.b
    )
    factor = F.col("times") * scoring.idf(F.lit(n_docs), F.col("df"))
    return words.join(shortest, ["term_bucket", "term"]).select(
        "qid", "term_bucket", "term", "df", factor.alias("factor"), (factor * most).alias("bound")
    )


def _score(
    index: LexicalIndex, field: str, words: DataFrame, keys: list[str], only: DataFrame | None = None
) -> DataFrame:
    """Sum of the words' scores per query and document. ``only`` lists the terms
    to read, for a join that has to shuffle the postings."""
    rows = index.postings.filter(F.col("field") == field)
    if only is not None:
        rows = rows.join(only, only.columns, "left_semi")
    part = field_saturation(index, field, F.col("tf"))
    return (
        rows.join(words, keys)
        .groupBy("qid", "doc_id")
        .agg(F.sum(F.col("factor") * part).alias("score"))
    )


def _floor(scores: DataFrame, k: int, decimals: int) -> DataFrame:
    """(qid, floor): a score each query's k-th hit reaches at least; no row for a
    query with fewer than k scored documents. Scores may leave words out."""
    return (
        top_k_per_query(scores, k, decimals=decimals)
        .groupBy("qid")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("floor"))
        .filter(F.col("_n") == k)
        .select("qid", (F.col("floor") - 2 * 10.0**-decimals).alias("floor"))
    )


def batch_top_k(
    index: LexicalIndex,
    queries: DataFrame,
    k: int = 5,
    field: str = BODY,
    prune: bool | None = None,
    decimals: int = scoring.SCORE_DECIMALS,
) -> DataFrame:
    """(qid, doc_id, score, rank) for queries (qid, text), ``qid`` unique.

    Scoring every document that shares any word with a query would pair each
    query that says "the" with most of the corpus. Instead: the weightiest words
    of a query give a score that its k-th hit reaches at least. Words whose
    bounds together stay below it cannot bring in a document on their own, so
    they are looked up only for documents that the other words found and that
    can still reach that score. The result is the same as without pruning, which
    is used when there are few matches anyway.
    """
    spark = index.docs.sparkSession
    # Written, so that Spark knows the size of the query side of each join: it
    # is broadcast when small and shuffled (with skew splitting) when not.
    words = write_table(query_words(index, queries, field), scratch_path(spark, "query-words"))
    by_term = ["term_bucket", "term"]
    if prune is None:
        prune = (words.agg(F.sum("df")).first()[0] or 0) > PLAIN_MATCHES
    if not prune:
        return top_k_per_query(_score(index, field, words, by_term), k, decimals=decimals)

    down = Window.partitionBy("qid").orderBy(F.desc("bound"), "term")
    up = Window.partitionBy("qid").orderBy("bound", F.desc("term"))
    seed_docs = max(k * SEED_DOCS_PER_HIT, int(index.fields[field][0] * SEED_SHARE))
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    seeds = words.withColumn("_found", F.coalesce(F.sum("df").over(before), F.lit(0))).filter(
        F.col("_found") < seed_docs
    )
    floor = _floor(_score(index, field, seeds, by_term), k, decimals)
    up_to = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = write_table(
        words.withColumn("_sum", F.sum("bound").over(up_to))
        .join(floor, "qid", "left")
        .withColumn("minor", F.coalesce(F.col("_sum") < F.col("floor"), F.lit(False)))
        .drop("_sum", "floor"),
        scratch_path(spark, "query-words-split"),
    )
    minor = split.filter("minor").select("qid", *by_term, "factor", "bound")
    partial = write_table(
        _score(index, field, split.filter("NOT minor").drop("minor"), by_term),
        scratch_path(spark, "query-scores"),
    )
    # The scores so far give a better floor, which most documents cannot reach
    # even with every minor word.
    rest = minor.groupBy("qid").agg(F.sum("bound").alias("rest"))
    limits = (
        split.select("qid").distinct()
        .join(rest, "qid", "left")
        .join(_floor(partial, k, decimals), "qid", "left")
    )
    candidates = write_table(
        partial.join(limits, "qid")
        .filter(F.col("floor").isNull() | (F.col("score") + F.coalesce("rest", F.lit(0.0)) >= F.col("floor")))
        .select("qid", "doc_id", "score"),
        scratch_path(spark, "query-candidates"),
    )
    lookups = candidates.select("qid", "doc_id").join(minor, "qid")
    terms = minor.select(*by_term).distinct()
    added = _score(index, field, lookups, [*by_term, "doc_id"], terms)
    total = candidates.unionByName(added).groupBy("qid", "doc_id").agg(F.sum("score").alias("score"))
    return top_k_per_query(total, k, decimals=decimals)
