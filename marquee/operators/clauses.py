"""Query clauses. Plain values that say what to match; see ``matching`` for how.

A bad value (a word for a numeric field, a leading wildcard, a multi-word
phrase on the body field) raises ``ValueError`` when the clause is made.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from marquee.operators.postings import BODY, FLOAT_FIELDS, INT_FIELDS, NUMERIC_FIELDS

# Ends of an open numeric range.
INT_LOW, INT_HIGH = 0, 2147483647
RATING_LOW, RATING_HIGH = 0.0, 10.0

# Fixed value: a fuzzy clause stands for this many closest terms.


def numeric_value(field: str, value) -> int | float:
    if field in FLOAT_FIELDS:
        return float(value)
    if isinstance(value, float) and not value.is_integer():
        raise ValueError(f"{field} takes whole numbers, not {value!r}")
    number = int(value)
    if not -INT_HIGH - 1 <= number <= INT_HIGH:
        raise ValueError(f"{field} takes 32-bit numbers, not {value!r}")
    return number


class Clause:
    """Base of all clauses."""


@dataclass(frozen=True)
class Term(Clause):
    """Any of the words of ``text``; equality when ``field`` is numeric."""

    text: str
    field: str = BODY

    def __post_init__(self):
        if self.field in NUMERIC_FIELDS:
            numeric_value(self.field, self.text)


@dataclass(frozen=True)
class Phrase(Clause):
    """The words of ``text`` in a row, or spread over ``slop`` extra places."""

    text: str
    field: str = BODY
    slop: int = 0

    def __post_init__(self):
        if self.field in NUMERIC_FIELDS:
            numeric_value(self.field, self.text)
        elif self.field == BODY and len(self.text.split()) > 1:
            raise ValueError(f"{BODY} keeps no positions; name a text field")
        if self.slop < 0:
            raise ValueError("slop must not be negative")


@dataclass(frozen=True)
class Range(Clause):
    """Values between two ends, either of which may be None for open.

    Numeric ranges always contain both ends; the two flags count for text only.
    """

    field: str
    lower: object = None
    upper: object = None
    include_lower: bool = True
    include_upper: bool = True

    def __post_init__(self):
        if self.field in NUMERIC_FIELDS:
            self.numeric_bounds()

    def numeric_bounds(self) -> tuple[int | float, int | float]:
        low, high = (INT_LOW, INT_HIGH) if self.field in INT_FIELDS else (RATING_LOW, RATING_HIGH)
        return (
            low if self.lower is None else numeric_value(self.field, self.lower),
            high if self.upper is None else numeric_value(self.field, self.upper),
        )


@dataclass(frozen=True)
class Prefix(Clause):
    text: str
    field: str = BODY


@dataclass(frozen=True)
class Wildcard(Clause):
    """``*`` for any characters, ``?`` for one; a backslash takes a character as is."""

    pattern: str
    field: str = BODY

    def __post_init__(self):
        if self.pattern[:1] in ("*", "?"):
            raise ValueError("a wildcard may not come first")


@dataclass(frozen=True)
class Regex(Clause):
    """Terms that match a regular expression as a whole."""

    pattern: str
    field: str = BODY


@dataclass(frozen=True)
class Fuzzy(Clause):
    """All terms within ``max_edits`` edits, or the closest ``max_expansions`` of them."""

    text: str
    field: str = BODY
    max_edits: int = 2
    max_expansions: int | None = None

    def __post_init__(self):
        if self.max_edits not in (0, 1, 2):
            raise ValueError("max_edits must be 0, 1 or 2")


@dataclass(frozen=True)
class MatchAll(Clause):
    """Every document, score 1."""


@dataclass(frozen=True)
class Boost(Clause):
    """The same documents with scores multiplied by ``factor``."""

    clause: Clause
    factor: float

    def __post_init__(self):
        if self.factor < 0:
            raise ValueError("factor must not be negative")


@dataclass(frozen=True)
class Bool(Clause):
    """All of ``must``, none of ``must_not``; ``should`` adds to the score, and
    at least one is needed when there is no ``must``."""

    must: tuple[Clause, ...] = ()
    should: tuple[Clause, ...] = ()
    must_not: tuple[Clause, ...] = ()

    def __post_init__(self):
        for name in ("must", "should", "must_not"):
            object.__setattr__(self, name, tuple(getattr(self, name)))


def leaves(clause: Clause) -> Iterable[Clause]:
    if isinstance(clause, Boost):
        yield from leaves(clause.clause)
    elif isinstance(clause, Bool):
        for child in (*clause.must, *clause.should, *clause.must_not):
            yield from leaves(child)
    else:
        yield clause
