"""Searches over built indexes: clause or text in, hit records out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scoring import SCORE_DECIMALS
from marquee.functions.vectors import Encoder, HashedEncoder, embed
from marquee.operators.batch import batch_top_k
from marquee.operators.clauses import Clause, Range, Term
from marquee.operators.dense import inner_product_top_k
from marquee.operators.matching import match
from marquee.operators.pruned import pruned_top_k
from marquee.operators.topk import fetch, fetch_known, hit_records, top_k
from marquee.sources.index_tables import LexicalIndex, open_index
from marquee.sources.dense_index import open_dense

# Fixed value: the search type that means the vector index; any other is lexical.
DENSE_TYPE = "bert"
# Fixed value: results shown when no number is asked for.
DEFAULT_K = 5

# Hit lists up to this length are looked up by constant ids.
MAX_KNOWN_HITS = 1000


def lexical_hits(index: LexicalIndex, clause: Clause, k: int = DEFAULT_K, decimals: int = SCORE_DECIMALS) -> DataFrame:
    """Ranked hits of a clause with their stored fields."""
    if isinstance(clause, Term) and k <= MAX_KNOWN_HITS:
        hits = pruned_top_k(index, clause, k, decimals)  # reads only ranges that can reach the k best
    else:
        hits = top_k(match(index, clause), k, decimals)
    return fetch_known(hits, index.stored) if k <= MAX_KNOWN_HITS else fetch(hits, index.stored)


def lexical_search(index: LexicalIndex, query: str | Clause, k: int = DEFAULT_K) -> DataFrame:
    """The k best records for a clause; plain text means any of its words."""
    clause = Term(query) if isinstance(query, str) else query
    return hit_records(lexical_hits(index, clause, k)).orderBy("rank")


def lexical_batch_search(index: LexicalIndex, queries: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The k best records for each row of (qid, text)."""
    return hit_records(fetch(batch_top_k(index, queries, k), index.stored), ("qid", "rank"))


def top_rated(index: LexicalIndex, k: int = DEFAULT_K) -> DataFrame:
    """The first k records, in document order, rated 8 or more."""
    return lexical_search(index, Range("rating", 8.0, None), k)


def _encoded(queries: DataFrame, encoder: Encoder) -> DataFrame:
    return queries.select("qid", embed(F.col("text"), encoder).alias("embedding"))


def _named(catalog: DataFrame) -> DataFrame:
    return catalog.withColumnRenamed("movie_name", "name")


def dense_batch_search(
    vectors: DataFrame, catalog: DataFrame, queries: DataFrame, encoder: Encoder, k: int = DEFAULT_K
) -> DataFrame:
    """The k records whose vectors have the highest inner product with each
    query's, for queries (qid, text). Fields are the raw ones, as text."""
    hits = inner_product_top_k(vectors, _encoded(queries, encoder), k)
    return hit_records(fetch(hits, _named(catalog)), ("qid", "rank"), stringify=True)


def dense_search(
    vectors: DataFrame, catalog: DataFrame, query: str, encoder: Encoder, k: int = DEFAULT_K
) -> DataFrame:
    """The k records for one text."""
    asked = catalog.sparkSession.range(1).select(F.col("id").alias("qid"), F.lit(query).alias("text"))
    hits = inner_product_top_k(vectors, _encoded(asked, encoder), k)
    look_up = fetch_known if k <= MAX_KNOWN_HITS else fetch
    return hit_records(look_up(hits, _named(catalog)), stringify=True).orderBy("rank")


@dataclass(frozen=True)
class SearchSite:
    """Both indexes under one folder, opened on first use."""

    spark: SparkSession
    path: str
    encoder: Encoder | None = None

    def lexical(self, **settings) -> LexicalIndex:
        return open_index(self.spark, f"{self.path}/lexical", **settings)

    def dense(self) -> tuple[DataFrame, DataFrame]:
        return open_dense(self.spark, f"{self.path}/dense")


def search(site: SearchSite, query: str | Clause, search_type: str, k: int = DEFAULT_K) -> DataFrame:
    """Dispatch by search type."""
    if search_type == DENSE_TYPE:
        if not isinstance(query, str):
            raise ValueError("a vector search takes plain text")
        return dense_search(*site.dense(), query, site.encoder or HashedEncoder(), k)
    return lexical_search(site.lexical(), query, k)
