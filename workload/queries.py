"""Every registered query: name to function of (spark, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.markup import extract_attribute
from marquee.functions.scoring import byte4_length, idf
from marquee.functions.text import (
    attention_mask,
    genre_without_short,
    pad_or_truncate,
    tokenize,
)
from marquee.functions.urls import PAGE_BASE, TITLE_BASE, segment_from_end, with_prefix
from marquee.functions.vectors import embed
from marquee.operators import postings as P
from marquee.operators.batch import batch_top_k
from marquee.operators.clauses import (
    Bool,
    Boost,
    Clause,
    Fuzzy,
    MatchAll,
    Phrase,
    Prefix,
    Range,
    Regex,
    Term,
    Wildcard,
)
from marquee.operators.cleaning import clean_catalog, with_all_fields
from marquee.operators.dedup import (
    attach_column,
    distinct_rows,
    keep_first,
    patch_ids,
    with_row_positions,
)
from marquee.operators.dense import blocked_top_k, inner_product_top_k, masked_mean_pool
from marquee.operators.matching import match
from marquee.operators.snippet import snippet
from marquee.operators.topk import fetch, hit_records, result_cards, top_k
from marquee.plans.search import lexical_hits, lexical_search, top_rated
from marquee.sources.hits_json import hits_from_json, hits_to_json
from marquee.sources.catalog import CATALOG_COLUMNS, read_catalog_csv
from marquee.sources.dense_index import open_dense
from marquee.plans.build import append_dense, build_dense
from marquee.sources.storage import scratch_path, spread
from workload.catalog import ENCODER, dense_tables, lexical_index, raw_catalog, table

Query = Callable[[SparkSession, str], DataFrame]

DECIMALS = 4
#: Added to the ids of appended records.
APPENDED = 1_000_000_000_000

# A permutation of numbers below 2^40.
SPARSE = "row_ord * 7919000017 % 1099511627776"

SOURCE_COLUMNS = (
    "movie_id", "movie_name", "year", "rating", "votes", "runtime", "certificate", "cast", "director", "genre",
    "plot", "meta_score", "gross", "movie_url",
)

# The clause queries; each gives every matching document with its score.
CLAUSES: dict[str, Clause] = {
    "term_match": Term("Comedy actor 12"),
    "fielded_term": Term("short DRAMA", "genre"),
    "int_exact": Term("1984", "year"),
    "float_exact": Term("6.8", "rating"),
    "int_range_open": Range("votes", 900, None),
    "float_range_open": Range("rating", None, 2.5),
    "exclusive_range_is_inclusive": Range("year", 1950, 1960, False, False),
    "text_range": Range("name", "the", "thm", True, False),
    "prefix": Prefix("Comed", "genre"),
    "wildcard": Wildcard("th?r*e", "plot"),
    "regex": Regex("(in)+g?[aeiou]t.*", "plot"),
    "fuzzy": Fuzzy("then", "plot"),
    "fuzzy_limited": Fuzzy("thsi", "plot", max_expansions=50),
    "phrase": Phrase("of the", "plot"),
    "phrase_slop": Phrase("the on and", "plot", slop=6),
    "bool_must_should_not": Bool(
        must=[Term("drama", "genre"), Range("rating", 4, 9)],
        should=[Term("the of"), Range("year", 1990, None), Boost(Term("actor", "cast"), 0.5)],
        must_not=[Term("short", "genre"), Range("votes", None, 100)],
    ),
    "nested_bool": Bool(
        must=[Bool(should=[Term("comedy", "genre"), Phrase("director 7", "director")]), Range("runtime", 10, 150)],
        should=[Bool(must=[Term("the"), Term("and")]), Term("1999", "year")],
        must_not=[Bool(must=[Term("en", "certificate"), Range("rating", None, 3)])],
    ),
    "numeric_or_words": Bool(
        should=[Range("rating", 9.5, None), Term("action", "genre")], must_not=[Term("0", "votes")]
    ),
    "numbers_only": Bool(
        must=[Range("year", 1960, 1999)], should=[Range("rating", 8, None), Boost(Range("votes", 500, None), 3)]
    ),
    "only_must_not_empty": Bool(should=[Bool(must_not=[Term("drama", "genre")]), Term("comedy", "genre")]),
    "bool_empty_word": Bool(
        must=[Term("drama", "genre"), Term("!!!", "genre")], should=[Term("...")], must_not=[Term("?", "plot")]
    ),
    "boost": Boost(Term("action unknown"), 2.5),
    "match_all": MatchAll(),
    "unindexed_field_empty": Bool(should=[Term("tt000000000001", "movie_id"), Term("drama", "genre")]),
}

BM25_TOP = Bool(should=[Term("comedy director the"), Term("actor", "cast"), Prefix("uni")])
BM25_RANGE = Bool(should=[Term("drama")], must=[Range("rating", 8.0, None)])


def _clause_query(clause: Clause) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = match(lexical_index(spark, sf_dir), clause)
        return found.select("doc_id", F.round("score", DECIMALS).alias("score"))

    return run


# -- cleaning and projections ----------------------------------------------


def q_clean_catalog(spark, sf_dir):
    return clean_catalog(raw_catalog(spark, sf_dir))


def q_dedup_key_first(spark, sf_dir):
    return keep_first(raw_catalog(spark, sf_dir), ["movie_id"], "row_ord").select("movie_id", "row_ord", "votes")


def q_dedup_full_row(spark, sf_dir):
    return distinct_rows(raw_catalog(spark, sf_dir), "row_ord")


def q_all_fields_text(spark, sf_dir):
    return with_all_fields(clean_catalog(raw_catalog(spark, sf_dir))).select("movie_id", "all_fields")


def q_row_ids(spark, sf_dir):
    rows = keep_first(raw_catalog(spark, sf_dir), ["movie_id"], "row_ord").select("movie_id", "row_ord")
    return with_row_positions(rows, "row_ord").select("movie_id", "doc_pos")


def q_row_ids_sparse(spark, sf_dir):
    """Positions by an order that leaves large gaps."""
    rows = raw_catalog(spark, sf_dir).select("row_ord", F.expr(SPARSE).alias("sparse"))
    return with_row_positions(rows, "sparse").select("row_ord", "doc_pos")


def q_csv_round_trip(spark, sf_dir):
    """The catalog written as CSV and read again."""
    columns = [F.col(c) if c in SOURCE_COLUMNS else F.lit("").alias(c) for c in CATALOG_COLUMNS]
    path = scratch_path(spark, "csv")
    raw_catalog(spark, sf_dir).select(*columns).write.csv(path, header=True, escape='"', emptyValue="")
    return read_catalog_csv(spark, path).select(*SOURCE_COLUMNS)


def q_snippet(spark, sf_dir):
    rows = distinct_rows(raw_catalog(spark, sf_dir), "row_ord")
    return rows.select("row_ord", snippet().alias("snippet"))


def q_genre_without_short(spark, sf_dir):
    return raw_catalog(spark, sf_dir).select("row_ord", genre_without_short(F.col("genre")).alias("genre"))


def q_id_patch(spark, sf_dir):
    """The correction table is derived from ``labels``."""
    wrong = F.concat(F.lit("tt"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    corrections = table(spark, sf_dir, "labels").select(
        wrong.alias("movie_id"), F.concat(F.lit("fix"), F.col("doc_id").cast("string")).alias("new_id")
    )
    return patch_ids(raw_catalog(spark, sf_dir).select("row_ord", "movie_id"), corrections)


# -- analysis and statistics -----------------------------------------------


def q_tokenize_counts(spark, sf_dir):
    docs = P.with_tokens(lexical_index(spark, sf_dir).docs)
    per_term = None
    for field in P.TEXT_FIELDS:
        words = docs.select(F.lit(field).alias("field"), F.explode(f"tokens_{field}").alias("term"))
        per_term = words if per_term is None else per_term.unionByName(words)
    return (
        per_term.groupBy("field", "term")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("field")
        .agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("terms"))
    )


def q_positions(spark, sf_dir):
    rows = lexical_index(spark, sf_dir).postings.filter(F.col("field") != P.BODY)
    return rows.select("field", "term", "doc_id", "tf", F.array_join("positions", ",").alias("positions"))


def q_term_freq(spark, sf_dir):
    rows = lexical_index(spark, sf_dir).postings.filter(F.col("field") == P.BODY)
    return rows.select("term", "doc_id", "tf", "dl")


def q_doc_freq(spark, sf_dir):
    return lexical_index(spark, sf_dir).terms.select("field", "term", "df")


def q_field_stats(spark, sf_dir):
    stats = P.field_stats(lexical_index(spark, sf_dir).docs)
    return stats.select("field", "n_docs", F.round("avg_len", 6).alias("avg_len"))


def q_idf(spark, sf_dir):
    index = lexical_index(spark, sf_dir)
    stats = P.field_stats(index.docs)
    return index.terms.join(F.broadcast(stats), "field").select(
        "field", "term", F.round(idf(F.col("n_docs"), F.col("df")), 6).alias("idf")
    )


def q_byte4_norms(spark, sf_dir):
    lengths = P.doc_lengths(lexical_index(spark, sf_dir).docs)
    return lengths.select("field", "doc_id", "dl", byte4_length(F.col("dl")).alias("kept"))


# -- ranking ----------------------------------------------------------------


def q_bm25_topk(spark, sf_dir):
    index = lexical_index(spark, sf_dir)
    hits = top_k(match(index, BM25_TOP), 10, DECIMALS)
    return hit_records(fetch(hits, index.stored))


def q_bm25_byte4_topk(spark, sf_dir):
    index = lexical_index(spark, sf_dir).with_scoring(norms="byte4", k1=0.9, b=0.4)
    hits = top_k(match(index, Term("the of and")), 10, DECIMALS)
    return hits.select("rank", "doc_id", "score")


def q_bm25_plus_range(spark, sf_dir):
    index = lexical_index(spark, sf_dir)
    return hit_records(lexical_hits(index, BM25_RANGE, 5, DECIMALS))


def q_term_topk_pruned(spark, sf_dir):
    """A common word and a rarer one: only document ranges that can reach the ten best are read."""
    index = lexical_index(spark, sf_dir)
    return hit_records(lexical_hits(index, Term("the comedy"), 10, DECIMALS))


def q_top_rated(spark, sf_dir):
    return top_rated(lexical_index(spark, sf_dir))


def _batch_queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def q_batch_queries_topk(spark, sf_dir):
    return batch_top_k(
        lexical_index(spark, sf_dir), _batch_queries(spark, sf_dir), 5, decimals=DECIMALS
    ).select("qid", "rank", "doc_id", "score")


def q_batch_queries_pruned_topk(spark, sf_dir):
    """The same by way of score bounds, as for a large corpus."""
    return batch_top_k(
        lexical_index(spark, sf_dir), _batch_queries(spark, sf_dir), 5, prune=True, decimals=DECIMALS
    ).select("qid", "rank", "doc_id", "score")


def q_result_card(spark, sf_dir):
    index = lexical_index(spark, sf_dir)
    return result_cards(lexical_hits(index, BM25_TOP, 10, DECIMALS))


def q_hits_json_roundtrip(spark, sf_dir):
    index = lexical_index(spark, sf_dir)
    hits = lexical_hits(index, BM25_TOP, 10, DECIMALS)
    return hits_from_json(hits_to_json(hits))


# -- vectors ----------------------------------------------------------------


def q_pad_truncate_mask(spark, sf_dir):
    tokens = tokenize(F.col("text"))
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.select("doc_id", tokens.alias("tokens"))
    return rows.select(
        "doc_id",
        F.array_join(pad_or_truncate(F.col("tokens"), 512, "<pad>"), " ").alias("tokens"),
        F.array_join(attention_mask(F.col("tokens"), 512), "").alias("mask"),
    )


def _vectors(spark, sf_dir) -> DataFrame:
    """The test vectors have unit length; stretched, so that an inner product
    differs from a cosine."""
    rows = table(spark, sf_dir, "embeddings")
    stretch = (F.col("vec_id") % 3 + 1).cast("float")
    return rows.select(
        F.col("vec_id").alias("doc_id"), F.transform("embedding", lambda x: x * stretch).alias("embedding"), "label"
    )


def _pooled(spark, sf_dir) -> DataFrame:
    masked = _vectors(spark, sf_dir).withColumn("mask", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1))
    return masked_mean_pool(masked, "label", "embedding", "mask")


def q_masked_mean_pool(spark, sf_dir):
    return _pooled(spark, sf_dir).select(
        "label", F.posexplode("embedding").alias("dim", "value")
    ).withColumn("value", F.round("value", 6))


def _label_queries(spark, sf_dir) -> DataFrame:
    return _pooled(spark, sf_dir).select(F.col("label").cast("long").alias("qid"), "embedding")


def q_inner_product_batch_topk(spark, sf_dir):
    hits = inner_product_top_k(_vectors(spark, sf_dir), _label_queries(spark, sf_dir), 7)
    return hits.select("qid", "rank", "doc_id", "score")


def q_inner_product_blocks_topk(spark, sf_dir):
    """Every vector as a query against all vectors, by cogrouped blocks of queries
    and batches of vectors (256 each here, so that the test tables make several)."""
    vectors = _vectors(spark, sf_dir)
    queries = vectors.select(F.col("doc_id").alias("qid"), "embedding")
    hits = blocked_top_k(vectors, queries, 3, query_block=256, vector_batch=256)
    return hits.select("qid", "rank", "doc_id", "score")


def q_inner_product_topk(spark, sf_dir):
    """One query: the mean of all vectors."""
    one = _vectors(spark, sf_dir).select(F.lit(0).cast("long").alias("qid"), "embedding", F.lit(1).alias("mask"))
    query = masked_mean_pool(one, "qid", "embedding", "mask")
    hits = inner_product_top_k(_vectors(spark, sf_dir), query, 5)
    return hits.select("rank", "doc_id", "score")


def q_k_exceeds_n(spark, sf_dir):
    """All vectors as queries over the few label means: asking for more hits
    than there are gives each of them once."""
    means = _label_queries(spark, sf_dir).withColumnRenamed("qid", "doc_id")
    queries = _vectors(spark, sf_dir).select(F.col("doc_id").alias("qid"), "embedding")
    hits = inner_product_top_k(means, queries, 1000)
    return hits.select("qid", "rank", "doc_id", "score")


def q_encode_documents(spark, sf_dir):
    vectors, _ = dense_tables(spark, sf_dir)
    return vectors.select("doc_id", F.posexplode("embedding").alias("dim", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 5)
    )


def q_dense_append(spark, sf_dir):
    """A dense index built over the catalog, then the catalog again appended under
    new ids (a second crawl): the vectors of the last snapshot whose catalog rows
    are there too."""
    out = scratch_path(spark, "append-site")
    raw = raw_catalog(spark, sf_dir)
    build_dense(spark, raw, out, ENCODER)
    append_dense(spark, raw.withColumn("row_ord", F.col("row_ord") + APPENDED), out, ENCODER)
    vectors, catalog = open_dense(spark, f"{out}/dense")
    kept = vectors.join(catalog.select("doc_id"), "doc_id", "left_semi")
    return kept.select("doc_id", F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.round(F.col("value").cast("double"), 5))


def _encoded_queries(spark, sf_dir):
    queries = _batch_queries(spark, sf_dir)
    return queries.select("qid", embed(F.col("text"), ENCODER).alias("embedding"))


def q_encode_search(spark, sf_dir):
    vectors, _ = dense_tables(spark, sf_dir)
    hits = inner_product_top_k(vectors, _encoded_queries(spark, sf_dir), 3, DECIMALS)
    return hits.select("qid", "rank", "doc_id", "score")


def q_hits_join_catalog(spark, sf_dir):
    vectors, catalog = dense_tables(spark, sf_dir)
    hits = inner_product_top_k(vectors, _encoded_queries(spark, sf_dir), 5, DECIMALS)
    named = catalog.withColumnRenamed("movie_name", "name")
    return hit_records(fetch(hits, named), ("qid", "rank"), stringify=True).withColumn("score", F.col("score").cast("double"))


# -- pages ------------------------------------------------------------------


def q_url_segment(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", segment_from_end(F.col("url")).alias("image_id"))


def _first_links(spark, sf_dir) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    link = extract_attribute(F.col("html"), "a", "href", None, "href")
    return pages.select("page_id", with_prefix(PAGE_BASE, link).alias("link"))


def q_first_link_extract(spark, sf_dir):
    return _first_links(spark, sf_dir)


def q_attach_image_url(spark, sf_dir):
    """Records gain the link found on the page with their number, if any."""
    found = _first_links(spark, sf_dir).select(
        F.concat(F.lit("tt"), F.lpad(F.col("page_id").cast("string"), 12, "0")).alias("movie_id"),
        F.col("link").alias("image_url"),
    )
    rows = raw_catalog(spark, sf_dir).select("row_ord", "movie_id", "movie_name")
    return attach_column(rows, found, "movie_id", "image_url")


def q_page_urls(spark, sf_dir):
    rows = raw_catalog(spark, sf_dir)
    return rows.select("row_ord", with_prefix(TITLE_BASE, F.col("movie_id")).alias("page_url"))


QUERIES: dict[str, Query] = {
    **{name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")},
    **{name: _clause_query(clause) for name, clause in CLAUSES.items()},
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best records for a word, among those rated 8 or more."""
    return lexical_search(lexical_index(spark, sf_dir), BM25_RANGE, 5)
