"""URL helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address prefixes that records and page links are joined to.
TITLE_BASE = "https://imdb.com/title/"
PAGE_BASE = "https://www.imdb.com/"


def with_prefix(base: str, value: Column) -> Column:
    return F.concat(F.lit(base), value)


def segment_from_end(url: Column, position: int = 2, suffix: str = "-curr") -> Column:
    """The n-th path piece counted from the end plus a suffix; null if too short."""
    return F.concat(
        F.try_element_at(F.split(url, "/"), F.lit(-position)), F.lit(suffix)
    )
