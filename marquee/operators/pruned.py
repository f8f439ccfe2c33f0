"""Top k of a text query, reading only the document ranges that can reach it.

The ``ranges`` table holds, per field, term and range of ``2^range_bits``
consecutive document ids, the largest BM25 term part there under the default
``k1`` and ``b``, and the largest ``tf`` and smallest length. It leaves out terms
of ``2^range_bits`` documents or fewer; those words' postings are read instead, of
which there are no more than a range has ids. ``idf`` times the
largest part, summed over the query's words, bounds every score inside the
range; under other ``k1``, ``b`` or norms, ``saturation(max_tf, min_dl)`` does, as
the term part grows with ``tf`` and falls with length.

1. The bounds of the query's words are read (their rows only) and summed per
   range by Spark.
2. The k ranges with the highest bounds hold at least k matching documents;
   their exact scores give ``theta``, the k-th best of them, a lower bound of the
   final k-th score. Only k rows come to the driver.
3. Only ranges whose bound reaches ``theta`` can hold a result. Their postings
   are read (the ids go into the scan as ranges of a block's ``from_id``, which
   Parquet uses on row groups and pages; beyond ``MAX_LITERAL_RANGES`` they are
   joined as a table instead), summed per document and ranked as usual.

For a single common word this reads about k ranges instead of every posting of
the word; the result is exactly the unpruned one, ties included, because a
range left out cannot reach the k-th score even after rounding.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import scoring
from marquee.functions.scoring import SCORE_DECIMALS
from marquee.operators.clauses import Term
from marquee.operators.matching import Matcher, field_saturation
from marquee.operators.postings import NUMERIC_FIELDS, SLICE_BITS
from marquee.operators.topk import top_k
from marquee.sources.index_tables import LexicalIndex
from marquee.sources.storage import scratch_path, write_table

#: Chosen ranges up to this number are named in the scan.
MAX_LITERAL_RANGES = 256
#: Chosen ranges up to this number are broadcast to the join beyond that.
MAX_BROADCAST_RANGES = 1 << 20


def _factors(matcher: Matcher, clause: Term) -> dict[str, float]:
    """Weight of each known word of the query: repeats times idf."""
    words = Counter(matcher.words[clause.text])
    return {w: n * matcher._idf(clause.field, w) for w, n in words.items() if (clause.field, w) in matcher.doc_freq}


def _factor_of(factors: dict[str, float]):
    return F.element_at(F.create_map(*[x for w, f in factors.items() for x in (F.lit(w), F.lit(f))]), F.col("term"))


def range_bounds(index: LexicalIndex, clause: Term) -> tuple[DataFrame, dict[str, float], Matcher] | None:
    """``doc_range`` and ``bound`` of every range where a word of the query occurs."""
    if not isinstance(clause, Term) or clause.field in NUMERIC_FIELDS:
        return None
    matcher = Matcher(index, clause)
    factors = _factors(matcher, clause)
    if not factors or index.ranges is None:
        return None
    if (index.k1, index.b, index.norms) == (scoring.K1, scoring.B, "exact"):
        part = F.col("max_part")  # the largest term part of the range itself
    else:  # a looser bound that holds for any k1 and b
        average = F.lit(index.fields[clause.field][1])
        length = scoring.byte4_length(F.col("min_dl")) if index.norms == "byte4" else F.col("min_dl")
        part = scoring.saturation(F.col("max_tf"), length, average, index.k1, index.b)
    # Words of few documents have no rows of ranges; their postings give the same.
    few = [w for w in factors if matcher.doc_freq[clause.field, w] <= 1 << index.range_bits]
    rows = matcher._lookup(index.ranges, clause.field, [w for w in factors if w not in few])
    rows = rows.select("term", "doc_range", part.alias("part"))
    if few:
        found = matcher._lookup(index.postings, clause.field, few)
        doc_range = F.call_function("shiftright", F.col("doc_id"), F.lit(index.range_bits))
        part = field_saturation(index, clause.field, F.col("tf"))
        rows = rows.unionByName(found.select("term", doc_range.alias("doc_range"), part.alias("part")))
    # A range may have several rows, each for some of its documents.
    most = rows.groupBy("term", "doc_range").agg(F.max("part").alias("part"))
    bounds = most.groupBy("doc_range").agg(F.sum(_factor_of(factors) * F.col("part")).alias("bound"))
    return bounds, factors, matcher


def _scores(index: LexicalIndex, matcher: Matcher, clause: Term, factors: dict[str, float], postings: DataFrame) -> DataFrame:
    part = field_saturation(index, clause.field, F.col("tf"))
    return postings.select("doc_id", (_factor_of(factors) * part).alias("score")).groupBy("doc_id").agg(F.sum("score").alias("score"))


def _in_ranges(bits: int, ranges: list[int]):
    """``doc_id`` inside any of the ranges, and ``from_id`` where a block that reaches
    into one can start, as merged intervals that Parquet can use."""
    spans: list[list[int]] = []
    for r in sorted(ranges):
        if spans and r == spans[-1][1] + 1:
            spans[-1][1] = r
        else:
            spans.append([r, r])
    test = blocks = F.lit(False)
    for low, high in spans:
        first, last = low << bits, ((high + 1) << bits) - 1
        test = test | F.col("doc_id").between(F.lit(first), F.lit(last))
        blocks = blocks | F.col("from_id").between(F.lit(first - (1 << SLICE_BITS) + 1), F.lit(last))
    return blocks & test


def candidate_ranges(index: LexicalIndex, clause: Term, k: int, decimals: int = SCORE_DECIMALS):
    """(postings of the query's words, chosen ranges as a table, their number,
    all ranges of the words), or None where the clause has no word to bound."""
    found = range_bounds(index, clause)
    if found is None or k <= 0:
        return None
    bounds, factors, matcher = found
    spark = index.docs.sparkSession
    bounds = write_table(bounds, scratch_path(spark, "range-bounds"))
    postings = matcher._lookup(index.postings, clause.field, list(factors))
    first = [r["doc_range"] for r in bounds.orderBy(F.desc("bound"), "doc_range").limit(k).collect()]
    best = top_k(_scores(index, matcher, clause, factors, postings.filter(_in_ranges(index.range_bits, first))), k, decimals).collect()
    # Each range holds a matching document, so k ranges hold k; theta is then a real k-th score.
    theta = min(r["score"] for r in best) - 10.0**-decimals if len(best) >= k else float("-inf")
    chosen = bounds.where(F.col("bound") >= F.lit(theta))
    return (postings, factors, matcher), chosen, chosen.count(), bounds.count()


def pruned_top_k(index: LexicalIndex, clause: Term, k: int = 5, decimals: int = SCORE_DECIMALS) -> DataFrame:
    """``top_k(match(index, clause), k, decimals)`` of a word clause, reading only
    ranges whose bound reaches the k-th score."""
    found = candidate_ranges(index, clause, k, decimals)
    if found is None:
        return top_k(Matcher(index, clause).matches(), k, decimals)
    (postings, factors, matcher), chosen, count, _ = found
    bits = index.range_bits
    if count <= MAX_LITERAL_RANGES:
        wanted = postings.filter(_in_ranges(bits, [r["doc_range"] for r in chosen.collect()]))
    else:
        keys = chosen.select("doc_range")
        keys = F.broadcast(keys) if count <= MAX_BROADCAST_RANGES else keys
        wanted = postings.withColumn("doc_range", F.call_function("shiftright", F.col("doc_id"), F.lit(bits))).join(keys, "doc_range")
    return top_k(_scores(index, matcher, clause, factors, wanted), k, decimals)
