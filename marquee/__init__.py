"""Catalog search on Spark: fielded BM25 search and exact vector search over
tables of records, built from DataFrame operations."""

from marquee.operators.clauses import (
    Bool,
    Boost,
    Fuzzy,
    MatchAll,
    Phrase,
    Prefix,
    Range,
    Regex,
    Term,
    Wildcard,
)
from marquee.plans.build import build, build_dense, build_lexical
from marquee.plans.search import SearchSite, search, top_rated

__all__ = [
    "Bool",
    "Boost",
    "Fuzzy",
    "MatchAll",
    "Phrase",
    "Prefix",
    "Range",
    "Regex",
    "SearchSite",
    "Term",
    "Wildcard",
    "build",
    "build_dense",
    "build_lexical",
    "search",
    "top_rated",
]
