"""Text analysis as Spark column expressions.

``tokenize`` is the one analyser used for documents and for queries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that join two letters or two digits inside one word
# (Unicode word-break classes MidLetter, MidNumLet and MidNum; the usual members).
LETTER_JOINERS = ":·.'‘’․"
DIGIT_JOINERS = ",;.'‘’․"

# Ideographs and Hiragana are words of their own; every other script forms runs.
# Quantifiers are possessive so that a very long run cannot exhaust the stack, and
# a run of underscores is tried from its start only. ASCII letters and the ASCII
# characters that begin no word are told apart first, without looking up a script.
_LETTERS = (
    r"[a-z[\p{L}\p{Nl}&&[^\p{IsHan}\p{IsHiragana}]]]"
    r"[a-z[\p{L}\p{Nl}\p{M}&&[^\p{IsHan}\p{IsHiragana}]]]*+"
)
_LETTER_RUN = f"{_LETTERS}(?:[{LETTER_JOINERS}]{_LETTERS})*+"
_DIGIT_RUN = rf"\p{{Nd}}++(?:[{DIGIT_JOINERS}]\p{{Nd}}++)*+"
WORD_PATTERN = (
    r"(?![\x00-/:-@\[-\^`{-\x7f])"
    f"(?:(?:(?<!_)_++)?+(?:{_LETTER_RUN}|{_DIGIT_RUN})(?:{_LETTER_RUN}|{_DIGIT_RUN}|_++)*+"
    r"|\p{IsHan}|\p{IsHiragana})"
)


def tokenize(text: Column) -> Column:
    """Lower-cased words of ``text`` in order; an empty array for null."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def or_default(text: Column, default: str) -> Column:
    """``default`` where ``text`` is the empty string or null."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(default)).otherwise(text)


def strip_trailing_chars(text: Column, chars: str) -> Column:
    """Remove any trailing characters that are members of ``chars``."""
    return F.rtrim(text, F.lit(chars))


def without_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def whole_number(text: Column, strict: bool = False) -> Column:
    """Text to int. Lenient reading accepts ``2023.0``; strict reading raises."""
    return text.cast("int") if strict else text.cast("double").cast("int")


def genre_without_short(genre: Column) -> Column:
    """Take the item ``Short`` out of a comma list, with its comma on either side."""
    for part in (",Short", "Short,", "Short"):
        genre = F.replace(genre, F.lit(part), F.lit(""))
    return genre


def pad_or_truncate(tokens: Column, length: int, pad) -> Column:
    """Exactly ``length`` items: cut the tail or fill it with ``pad``."""
    kept = F.slice(tokens, 1, length)
    return F.concat(kept, F.array_repeat(F.lit(pad), F.lit(length) - F.size(kept)))


def attention_mask(tokens: Column, length: int) -> Column:
    """1 for each kept token, 0 for each pad position."""
    kept = F.least(F.size(tokens), F.lit(length))
    return F.concat(
        F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), F.lit(length) - kept)
    )
