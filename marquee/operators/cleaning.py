"""Raw catalog rows to typed, deduplicated, searchable rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import (
    or_default,
    strip_trailing_chars,
    whole_number,
    without_commas,
)
from marquee.operators.dedup import keep_first

UNUSED_COLUMNS = ("meta_score", "gross")
UNKNOWN_COLUMNS = ("cast", "director", "genre", "plot", "certificate")
# The parts of ``all_fields``, in order; the plot is appended last.
SUMMARY_COLUMNS = ("name", "cast", "director", "genre", "certificate", "year")


def clean_values(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Sentinels for missing values, unit and comma removal, and typed numbers."""
    filled = {c: or_default(F.col(c), "Unknown") for c in UNKNOWN_COLUMNS}
    year, rating, votes, runtime = (
        or_default(F.col(c), "0") for c in ("year", "rating", "votes", "runtime")
    )
    return (
        raw.drop(*UNUSED_COLUMNS)
        .withColumnRenamed("movie_name", "name")
        .withColumns(
            {
                **filled,
                "year": whole_number(year, strict),
                "rating": rating.cast("float"),
                "votes": whole_number(without_commas(votes), strict),
                "runtime": whole_number(
                    without_commas(strip_trailing_chars(runtime, " min")), strict
                ),
            }
        )
    )


def with_all_fields(cleaned: DataFrame) -> DataFrame:
    """One text column holding every searchable field, the plot last."""
    parts = [F.col(c).cast("string") for c in (*SUMMARY_COLUMNS, "plot")]
    return cleaned.withColumn("all_fields", F.concat_ws(" ", *parts))


def clean_catalog(raw: DataFrame, strict: bool = False, order: str = "row_ord") -> DataFrame:
    """First row per ``movie_id`` in input order, cleaned and typed."""
    return clean_values(keep_first(raw, ["movie_id"], order), strict)
