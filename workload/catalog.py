"""A movie-shaped catalog derived from the ``documents`` table.

Every row keeps its whole text: the first line is the title, all of it the plot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.vectors import HashedEncoder
from marquee.plans.build import build_dense, build_lexical
from marquee.plans.search import SearchSite
from marquee.sources.index_tables import LexicalIndex
from marquee.sources.storage import scratch_path

# Read by Spark and by the checking engine alike. ``copy`` is 0 for the row
# itself, 1 for an exact copy, 2 for a later row with the same key and 3 for a
# record of its own that has no plot.
ROW_SQL = """
  doc_id * 4 + copy as row_ord,
  case when copy = 3 then 'tx' else 'tt' end || lpad(cast(doc_id as string), 12, '0') as movie_id,
  case when doc_id % 30 = 3 then 'Short ' else '' end || split_part(text, chr(10), 1) as movie_name,
  case when doc_id % 11 = 0 then '' when doc_id % 12 = 5 then cast(1920 + doc_id % 104 as string) || '.0'
       else cast(1920 + doc_id % 104 as string) end as year,
  case when doc_id % 13 = 0 then '' else cast(cast(doc_id % 91 as double) / 10 + 1 as string) end as rating,
  case when copy = 2 then '7' when doc_id % 17 = 0 then ''
       when doc_id % 5 = 0 then '1,' || lpad(cast(doc_id % 1000 as string), 3, '0')
       else cast(doc_id % 1000 as string) end as votes,
  case when doc_id % 7 = 0 then ''
       when doc_id % 50 = 1 then '1,' || lpad(cast(doc_id % 200 as string), 3, '0') || ' min'
       else cast(doc_id % 200 as string) || ' min' end as runtime,
  case when doc_id % 9 = 0 then '' else lang end as certificate,
  case when doc_id % 8 = 0 then ''
       else 'Actor ' || cast(doc_id % 37 as string) || ',Actor ' || cast(doc_id % 41 as string) end as "cast",
  case when doc_id % 10 = 0 then '' else 'Director ' || cast(doc_id % 23 as string) end as director,
  case doc_id % 6 when 0 then 'Short,Comedy,Drama' when 1 then 'Drama' when 2 then 'Comedy,Short'
       when 3 then 'Short' when 4 then '' else 'Action,Drama' end as genre,
  case when copy = 3 then '' else replace(text, chr(10), ' ') end as plot,
  '' as meta_score, '' as gross,
  'http://img.example/' || cast(doc_id as string) || '.jpg' as movie_url
"""

COPIES = {1: "doc_id % 25 = 0", 2: "doc_id % 40 = 0", 3: "doc_id % 19 = 0"}

ENCODER = HashedEncoder(dim=16)

_sites: dict[tuple[str, str], SearchSite] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = [F.lit(0), *[F.when(F.expr(test), F.lit(c)) for c, test in COPIES.items()]]
    documents = table(spark, sf_dir, "documents")
    copied = documents.select(
        "doc_id", "text", "lang",
        F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull())).alias("copy"),
    )
    return spark.sql(
        f"select {ROW_SQL.replace(chr(34) + 'cast' + chr(34), '`cast`')} from {{copied}}", copied=copied
    )


def site(spark: SparkSession, sf_dir: str) -> SearchSite:
    """The search site of a data folder; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _sites:
        _sites[key] = SearchSite(spark, scratch_path(spark, "site"), ENCODER)
    return _sites[key]


_built: set[tuple[str, str]] = set()


def _build_once(spark: SparkSession, sf_dir: str, kind: str) -> SearchSite:
    place = site(spark, sf_dir)
    if (place.path, kind) not in _built:
        if kind == "lexical":
            build_lexical(spark, raw_catalog(spark, sf_dir), place.path)
        else:
            build_dense(spark, raw_catalog(spark, sf_dir), place.path, ENCODER)
        _built.add((place.path, kind))
    return place


def lexical_index(spark: SparkSession, sf_dir: str) -> LexicalIndex:
    return _build_once(spark, sf_dir, "lexical").lexical()


def dense_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _build_once(spark, sf_dir, "dense").dense()
