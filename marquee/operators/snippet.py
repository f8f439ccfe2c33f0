"""One templated paragraph per record, used as the text that is embedded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import genre_without_short, whole_number

# Sentence openings of the paragraph.
SHORT_TITLE = "The short film is titled "
TITLE = "The film is titled "
STARS = "It stars "
DIRECTED = "It was directed by "
GENRES = "It is of the genre(s) "
RELEASED = "It was released on "
PLOT = "A short description is as follows: "


def _sentence(column: str, opening: str, value: Column, end: str = ".") -> Column:
    text = F.concat(F.lit(opening), value, F.lit(end))
    return F.when(F.coalesce(F.col(column), F.lit("")) != "", text).otherwise("")


def snippet() -> Column:
    """Paragraph over the raw columns; a sentence is left out when its field is empty."""
    is_short = F.coalesce(F.col("genre"), F.lit("")).contains("Short")
    opening = F.when(is_short, SHORT_TITLE).otherwise(TITLE)
    year = whole_number(F.nullif(F.col("year"), F.lit(""))).cast("string")
    return F.concat(
        opening,
        F.coalesce("movie_name", F.lit("")),
        F.lit("."),
        _sentence("cast", STARS, F.col("cast")),
        _sentence("director", DIRECTED, F.col("director")),
        _sentence("genre", GENRES, genre_without_short(F.col("genre"))),
        _sentence("year", RELEASED, year),
        _sentence("plot", PLOT, F.col("plot"), end=""),
    )
