"""Quality rules kept in a bitmask ledger.

Each document is measured once and each rule is evaluated once. The ledger row
holds the measurements and one ``failures`` number with bit ``i`` set where rule
``i`` failed. A policy is a versioned mask over those bits, so that changing a
policy, or asking what each rule costs, reads the small ledger and no text.

Defined cases: a null text counts as empty (all measures 0); an empty text has no
words and fails ``few_words``; repeated rows give one ledger row each; null ids
are carried through; further columns of the input are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measures; it must not be null."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 45 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
)

# Versions are only ever added, so that an old verdict can be repeated.
POLICIES = {"base": 0b000011, "v1": 0b001111, "v2": 0b111111}
BASE, CURRENT = "base", "v2"


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the measures of each row, by built-in functions alone.

    Repeated windows are found by sorting the three-word windows of a text and
    looking at neighbours, so that a very long text costs n log n.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        F.struct(*keep).alias("kept"),
        body.alias("body"),
        F.array_remove(F.split(body, SPACES), "").alias("words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE)).alias("lines"),
    )
    windows = F.greatest(F.size("words") - 2, F.lit(0))
    part = lambda at: F.slice("words", at, windows)
    places = F.slice(F.sequence(F.lit(1), F.size("words") + 1), F.lit(1), windows)
    sorted_ = split.select(
        "kept",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("body", NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(
            F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), places.alias("at"))
        ).alias("windows"),
    )
    n = F.greatest(F.size("windows") - 1, F.lit(0))
    equal = sorted_.withColumn(
        "same",
        F.zip_with(
            F.slice("windows", 1, n),
            F.slice("windows", 2, n),
            lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]),
        ),
    )
    flag = lambda i: F.coalesce(F.get("same", i), F.lit(False))
    repeats = equal.withColumn(
        "at",
        F.when(F.array_contains("same", True), F.sort_array(F.filter("windows", lambda _, i: flag(i) | flag(i - 1))["at"]))
        .otherwise(F.array().cast("array<int>")),
    )
    gaps = F.greatest(F.size("at") - 1, F.lit(0))
    covered = F.aggregate(
        F.zip_with(F.slice("at", 1, gaps), F.slice("at", 2, gaps), lambda x, y: F.least(F.lit(3), y - x)),
        F.when(F.size("at") > 0, F.lit(3).cast("long")).otherwise(F.lit(0).cast("long")),
        lambda total, x: total + x,
    )
    # A generator of one row: conditions on the measures are not pushed below it, where they would repeat all
    # the steps above once for each mention of a measure.
    result = F.struct("kept.*", *MEASURES[:-1], covered.alias("n_repeat_words"))
    return repeats.select(F.inline_outer(F.array(result)))


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules=RULES) -> DataFrame:
    """``keep``, the measures and ``failures`` of each row."""
    bits = [F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measured(docs, text, keep).withColumn("failures", failures)


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def ablation(rows: DataFrame, policy: str = CURRENT, rules=RULES) -> DataFrame:
    """For each rule of the policy: rows failing it, rows kept with the policy
    and rows kept without the rule.

    The ledger is first counted by ``failures`` (at most one group per
    combination of bits), and all figures come from those counts.
    """
    mask = POLICIES[policy]
    counts = rows.groupBy("failures").agg(F.count("*").alias("n"))
    table = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if mask >> r.bit & 1]
    )
    per_rule = counts.select("failures", "n", F.inline(table))
    masked = F.col("failures").bitwiseAND(F.lit(mask).cast("long"))
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    return per_rule.groupBy("rule", "bit").agg(
        total(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(masked == 0).alias("n_kept"),
        total(masked.bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"),
    )


def judged(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``."""
    return ledger(docs).withColumns(
        {"base_failed": ~passes(BASE), "kept": passes(BASE) & passes(policy)}
    )


def kept_rows(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The input rows that pass, with all their columns."""
    columns = docs.columns
    rows = docs.select(F.col("text").alias("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    return ledger(rows, "text", ("row",)).where(passes(BASE) & passes(policy)).select("row.*")
