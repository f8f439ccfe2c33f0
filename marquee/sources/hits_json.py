"""Hit lists as JSON text and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.topk import HIT_FIELDS, hit_records

# One record of a list whose numbers are numbers, and of one that is all text.
TYPED_RECORD = (
    "score double, name string, year int, rating float, votes int, runtime int, "
    "certificate string, cast string, director string, genre string, plot string, "
    "movie_id string, movie_url string"
)
TEXT_RECORD = ", ".join(f"{c} string" for c in HIT_FIELDS)


def hits_to_json(hits: DataFrame, by: tuple[str, ...] = (), stringify: bool = False) -> DataFrame:
    """One JSON array per hit list, in rank order. A list holds k records."""
    records = hit_records(hits, (*by, "rank"), stringify)
    ranked = F.sort_array(F.collect_list(F.struct("rank", F.struct(*HIT_FIELDS).alias("hit"))))
    return records.groupBy(*by).agg(F.to_json(F.transform(ranked, lambda r: r["hit"])).alias("hits"))


def hits_from_json(lists: DataFrame, column: str = "hits", record: str = TYPED_RECORD) -> DataFrame:
    """Back to one row per record, with its rank."""
    others = [c for c in lists.columns if c != column]
    parsed = F.from_json(F.col(column), f"array<struct<{record}>>")
    return lists.select(*others, F.posexplode(parsed).alias("rank", "hit")).select(
        *others, (F.col("rank") + 1).alias("rank"), "hit.*"
    )
