"""Clauses to DataFrames of (doc_id, score).

Every clause is a filter over the sorted postings table or over the numeric
columns of the document table. Words are analysed by the same expression as the
documents; the only values that come to the driver are the words of the query
and their document frequencies.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions import scoring
from marquee.functions.text import tokenize
from marquee.operators import clauses as C
from marquee.operators.postings import FLOAT_FIELDS, MAX_DELETION_LEN, NUMERIC_FIELDS, term_bucket_of
from marquee.sources.index_tables import LexicalIndex
from marquee.sources.storage import scratch_path, write_table

# The ids a required word clause allows are sent to all tasks when its document
# frequencies show that there are at most this many (about 8 MB of ids).
ANCHOR_DOCS = 1_000_000

# Required clauses are counted in the bits of one long; beyond this many a set
# is used.
_MASK_BITS = 60


def analyze_texts(spark: SparkSession, texts: list[str]) -> dict[str, list[str]]:
    """Query texts to words, by the analyser of the documents."""
    if not texts:
        return {}
    row = spark.range(1).select(F.array(*[tokenize(F.lit(t)) for t in texts])).first()
    return dict(zip(texts, row[0]))


def stored_length(index: LexicalIndex) -> Column:
    return scoring.byte4_length(F.col("dl")) if index.norms == "byte4" else F.col("dl")


def field_saturation(index: LexicalIndex, field: str, tf: Column) -> Column:
    average = F.lit(index.fields[field][1])
    return scoring.saturation(tf, stored_length(index), average, index.k1, index.b)


#: Candidate terms of a fuzzy clause up to this number are named in the scan.
MAX_CANDIDATES = 10_000


def edit_distance(term: Column, text: str, max_edits: int) -> Column:
    """Edits (at most 2 are told apart) between a column and a text, a swap of
    two neighbours counting as one edit and no place being edited twice; some
    larger number beyond ``max_edits``."""

    def edits(value: Column, word: str, limit: int) -> Column:
        # The function gives -1 beyond its limit; the remainder makes that 99.
        return F.pmod(F.levenshtein(value, F.lit(word), limit), F.lit(100))

    options = [edits(term, text, max_edits), F.lit(99)]
    places = [i for i in range(len(text) - 1) if text[i] != text[i + 1]] if max_edits else []
    for i in places:
        before, swapped, after = text[:i], text[i + 1] + text[i], text[i + 2 :]
        options.append(F.when(term == before + swapped + after, 1).otherwise(99))
        if max_edits < 2:
            continue
        # One more edit is either all behind the swapped pair or all before it.
        behind = F.substring(term, i + 3, 1 << 20)
        ahead = F.substring(term, F.lit(1), F.length(term) - (len(after) + 2))
        options += [
            F.when(term.startswith(before + swapped), 1 + edits(behind, after, 1)).otherwise(99),
            F.when(term.endswith(swapped + after), 1 + edits(ahead, before, 1)).otherwise(99),
        ]
        twice = [
            before + swapped + text[i + 2 : j] + text[j + 1] + text[j] + text[j + 2 :]
            for j in places
            if j > i + 1
        ]
        if twice:
            options.append(F.when(term.isin(*twice), 2).otherwise(99))
    return F.least(*options)


def like_pattern(pattern: str) -> tuple[str, str]:
    """A wildcard pattern as a LIKE pattern, and the fixed text it starts with."""
    out, prefix, fixed = [], [], True
    chars = iter(pattern)
    for ch in chars:
        if ch in "*?":
            out.append("%" if ch == "*" else "_")
            fixed = False
            continue
        if ch == "\\":
            ch = next(chars, "\\")
        out.append("\\" + ch if ch in "%_\\" else ch)
        if fixed:
            prefix.append(ch)
    return "".join(out), "".join(prefix)


def _minus(offset: int):
    return lambda position: position - offset


def _semi(rows: DataFrame, only: DataFrame | None) -> DataFrame:
    return rows if only is None else rows.join(F.broadcast(only), "doc_id", "left_semi")


def _tagged(word: int):
    return lambda start: F.struct(F.lit(word).alias("word"), start.alias("at"))


class Matcher:
    """Turns one clause tree into matches over one index."""

    def __init__(self, index: LexicalIndex, clause: C.Clause):
        self.index = index
        self.spark = index.docs.sparkSession
        self.clause = clause
        worded = [
            c for c in C.leaves(clause)
            if isinstance(c, (C.Term, C.Phrase)) and c.field not in NUMERIC_FIELDS
        ]
        self.words = analyze_texts(self.spark, sorted({c.text for c in worded}))
        for c in worded:
            if isinstance(c, C.Phrase) and c.field == C.BODY and len(self.words[c.text]) > 1:
                raise ValueError(f"{C.BODY} keeps no positions; name a text field")
        self.doc_freq = self._doc_freqs({(c.field, w) for c in worded for w in self.words[c.text]})

    def matches(self) -> DataFrame:
        return self._rows(self.clause, 1.0)

    # -- table access ------------------------------------------------------

    def _lookup(self, table: DataFrame, field: str, terms: list[str]) -> DataFrame:
        """Rows of a sorted table for known terms; folders and row groups prune."""
        buckets = sorted({term_bucket_of(t, self.index.buckets) for t in terms})
        return table.filter(
            (F.col("field") == field)
            & F.col("term_bucket").isin(*buckets)
            & F.col("term").isin(*terms)
        )

    def _doc_freqs(self, wanted: set[tuple[str, str]]) -> dict[tuple[str, str], int]:
        by_field = defaultdict(list)
        for field, word in sorted(wanted):
            by_field[field].append(word)
        parts = [
            self._lookup(self.index.terms, f, ws).select("field", "term", "df")
            for f, ws in by_field.items()
        ]
        if not parts:
            return {}
        rows = reduce(DataFrame.unionByName, parts).collect()
        return {(r["field"], r["term"]): r["df"] for r in rows}

    def _nothing(self) -> DataFrame:
        return self.index.points.select("doc_id", F.lit(0.0).alias("score")).filter(F.lit(False))

    def _idf(self, field: str, word: str) -> float:
        return self._idf_of(field, self.doc_freq[field, word])

    def _idf_of(self, field: str, df: int) -> float:
        n = self.index.fields[field][0]
        return math.log(1 + (n - df + 0.5) / (df + 0.5))

    # -- dispatch ----------------------------------------------------------

    def _rows(self, clause: C.Clause, weight: float, only: DataFrame | None = None) -> DataFrame:
        """Matches of a clause. ``only`` holds the few ids that still count; a
        clause that would shuffle other documents leaves them out early."""
        if isinstance(clause, C.Boost):
            return self._rows(clause.clause, weight * clause.factor, only)
        if isinstance(clause, C.Bool):
            return self._bool(clause, weight, only)
        condition = self._numeric(clause)
        if condition is not None:
            return self.index.points.filter(condition).select(
                "doc_id", F.lit(float(weight)).alias("score")
            )
        if isinstance(clause, C.Term) or (isinstance(clause, C.Phrase) and len(self.words[clause.text]) < 2):
            rows = self._term_rows([(0, clause, weight)])
            if len(set(self.words[clause.text])) > 1:
                rows = rows.groupBy("doc_id").agg(F.sum("score").alias("score"))
            return rows.select("doc_id", "score")
        if isinstance(clause, C.Phrase):
            return self._phrase(clause, weight, only)
        if isinstance(clause, C.Fuzzy):
            return self._fuzzy(clause, weight)
        # The test runs over the vocabulary. The terms it leaves are written, so that
        # the join knows how many they are and the postings are not tested again.
        terms = self.index.terms.filter((F.col("field") == clause.field) & self._term_test(clause))
        terms = write_table(terms.select("term_bucket", "term"), scratch_path(self.spark, "chosen-terms"))
        return (
            self.index.postings.filter(F.col("field") == clause.field)
            .join(terms, ["term_bucket", "term"])
            .select("doc_id")
            .distinct()
            .withColumn("score", F.lit(float(weight)))
        )

    def _numeric(self, clause: C.Clause) -> Column | None:
        """The clause as a condition on the document table, if it is one."""
        if isinstance(clause, C.MatchAll):
            return F.lit(True)
        field = getattr(clause, "field", None)
        if field not in NUMERIC_FIELDS:
            return None
        kind = "float" if field in FLOAT_FIELDS else "int"
        if isinstance(clause, C.Range):
            low, high = (F.lit(v).cast(kind) for v in clause.numeric_bounds())
            return F.col(field).between(low, high)
        if isinstance(clause, (C.Term, C.Phrase)):
            return F.col(field) == F.lit(C.numeric_value(field, clause.text)).cast(kind)
        return F.lit(False)

    def _term_test(self, clause: C.Clause) -> Column:
        """Clauses that select terms by a test and score 1 per document."""
        term = F.col("term")
        if isinstance(clause, C.Prefix):
            return term.startswith(clause.text.lower())
        if isinstance(clause, C.Wildcard):
            like, prefix = like_pattern(clause.pattern.lower())
            return term.startswith(prefix) & term.like(like)
        if isinstance(clause, C.Regex):
            return term.rlike(f"(?iu)^(?:{clause.pattern})$")
        tests = []
        if clause.lower is not None:
            low = F.lit(str(clause.lower).lower())
            tests.append(term >= low if clause.include_lower else term > low)
        if clause.upper is not None:
            high = F.lit(str(clause.upper).lower())
            tests.append(term <= high if clause.include_upper else term < high)
        return reduce(Column.__and__, tests, F.lit(True))

    # -- words -------------------------------------------------------------

    def _term_rows(self, entries: list[tuple[int, C.Clause, float]]) -> DataFrame:
        """(doc_id, slot, score) for many word clauses, one scan per field."""
        by_field: dict[str, dict[str, list[Column]]] = defaultdict(lambda: defaultdict(list))
        for slot, clause, weight in entries:
            for word, times in Counter(self.words[clause.text]).items():
                if (clause.field, word) in self.doc_freq:
                    factor = weight * times * self._idf(clause.field, word)
                    by_field[clause.field][word].append(
                        F.struct(F.lit(slot).alias("slot"), F.lit(factor).alias("factor"))
                    )
        parts = []
        for field, by_word in by_field.items():
            factors = F.create_map(
                *[x for word, uses in by_word.items() for x in (F.lit(word), F.array(*uses))]
            )
            part = field_saturation(self.index, field, F.col("tf"))
            parts.append(
                self._lookup(self.index.postings, field, list(by_word))
                .select("doc_id", part.alias("part"), F.inline(F.element_at(factors, F.col("term"))))
                .select("doc_id", "slot", (F.col("factor") * F.col("part")).alias("score"))
            )
        if not parts:
            return self._nothing().select("doc_id", F.lit(0).alias("slot"), "score")
        return reduce(DataFrame.unionByName, parts)

    def _phrase(self, clause: C.Phrase, weight: float, only: DataFrame | None) -> DataFrame:
        """Start positions of each word, brought to one row per document."""
        words = self.words[clause.text]
        field = clause.field
        if any((field, w) not in self.doc_freq for w in words):
            return self._nothing()
        rows = self._lookup(self.index.postings, field, sorted(set(words)))
        rarest = min(words, key=lambda w: self.doc_freq[field, w])
        if self.doc_freq[field, rarest] <= ANCHOR_DOCS:
            only = self._lookup(self.index.postings, field, [rarest]).select("doc_id")
        # Shuffled before grouping: words lie in different files, so there is
        # nothing to combine (only to sort) on the way.
        rows = _semi(rows, only).repartition("doc_id")
        starts = [
            F.first(
                F.when(F.col("term") == w, F.transform("positions", _minus(i))),
                ignorenulls=True,
            ).alias(f"s{i}")
            for i, w in enumerate(words)
        ]
        names = [f"s{i}" for i in range(len(words))]
        by_doc = rows.groupBy("doc_id").agg(F.first("dl").alias("dl"), *starts).dropna(subset=names)
        if clause.slop == 0:
            common = reduce(F.array_intersect, [F.col(n) for n in names])
            found = by_doc.select("doc_id", "dl", F.size(common).cast("double").alias("freq"))
        else:
            found = self._near(by_doc, names, clause.slop)
        idf = weight * sum(self._idf(field, w) for w in words)
        return found.filter(F.col("freq") > 0).select(
            "doc_id", (F.lit(idf) * field_saturation(self.index, field, F.col("freq"))).alias("score")
        )

    def _near(self, by_doc: DataFrame, names: list[str], slop: int) -> DataFrame:
        """Sum of 1/(1+spread) over the smallest windows that hold every word.

        All steps group by document first, so the partitioning of ``by_doc`` is
        kept and nothing is shuffled again.
        """
        tagged = [
            F.transform(n, _tagged(i))
            for i, n in enumerate(names)
        ]
        seen = by_doc.select("doc_id", "dl", F.inline(F.concat(*tagged)))
        so_far = Window.partitionBy("doc_id").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
        last = {f"last{i}": F.max(F.when(F.col("word") == i, F.col("at"))).over(so_far) for i in range(len(names))}
        return (
            seen.withColumns(last)
            .dropna(subset=list(last))
            .withColumn("lead", F.least(*last))
            .groupBy("doc_id", "dl", "lead")
            .agg(F.min(F.col("at") - F.col("lead")).alias("spread"))
            .filter(F.col("spread") <= slop)
            .groupBy("doc_id", "dl")
            .agg(F.sum(1 / (1 + F.col("spread"))).alias("freq"))
        )

    def _fuzzy(self, clause: C.Fuzzy, weight: float) -> DataFrame:
        """The closest terms of the vocabulary, scored as if equally frequent."""
        text, field = clause.text.lower(), clause.field
        if field not in self.index.fields:
            return self._nothing()
        # An edited term must keep at least one character of the shorter side.
        shorter = F.least(F.length("term"), F.lit(len(text)))
        allowed = F.least(F.lit(clause.max_edits), F.greatest(shorter - 1, F.lit(0)))
        edits = edit_distance(F.col("term"), text, clause.max_edits)
        near = (
            self._fuzzy_candidates(text, field, clause.max_edits)
            .filter(F.abs(F.length("term") - len(text)) <= clause.max_edits)
            .filter(edits <= allowed)
            .select("term_bucket", "term", "df", (1 - edits / shorter).alias("likeness"))
        )
        if clause.max_expansions is None:
            return self._fuzzy_all(near, field, weight)
        terms = near.orderBy(F.desc("likeness"), "term").limit(clause.max_expansions).collect()
        if not terms:
            return self._nothing()
        idf = self._idf_of(field, max(r["df"] for r in terms))
        factors = F.create_map(
            *[F.lit(v) for r in terms for v in (r["term"], weight * r["likeness"] * idf)]
        )
        part = field_saturation(self.index, field, F.col("tf"))
        return (
            self._lookup(self.index.postings, field, [r["term"] for r in terms])
            .groupBy("doc_id")
            .agg(F.sum(F.element_at(factors, F.col("term")) * part).alias("score"))
        )

    def _fuzzy_candidates(self, text: str, field: str, max_edits: int) -> DataFrame:
        """Terms rows that may lie within ``max_edits`` of ``text``: those that share a
        deletion key with it (one edit, a neighbour swap included, costs at most one
        deletion on each side). Where a match could be longer than the deletion table
        holds, all terms of the field."""
        every = self.index.terms.filter(F.col("field") == field)
        if self.index.deletions is None or len(text) + max_edits > MAX_DELETION_LEN:
            return every
        keys = {text}
        for _ in range(max_edits):
            keys |= {k[:i] + k[i + 1 :] for k in keys for i in range(len(k))}
        found = self._lookup(self.index.deletions.withColumnRenamed("term", "_t").withColumnRenamed("key", "term"), field, sorted(keys))
        terms = sorted({r["_t"] for r in found.select("_t").distinct().limit(MAX_CANDIDATES + 1).collect()})
        if len(terms) > MAX_CANDIDATES:
            return every.join(found.select(F.col("_t").alias("term")).distinct(), "term")
        return self._lookup(self.index.terms, field, terms) if terms else every.filter(F.lit(False))

    def _fuzzy_all(self, near: DataFrame, field: str, weight: float) -> DataFrame:
        """All near terms, which may be many. They are written first: that gives
        the join a side of known size, and keeps Spark from also testing the
        edit distance on every posting."""
        near = write_table(near, scratch_path(self.spark, "near-terms"))
        idf = self._idf_of(field, near.agg(F.max("df")).first()[0] or 0)
        part = field_saturation(self.index, field, F.col("tf"))
        return (
            self.index.postings.filter(F.col("field") == field)
            .join(near, ["term_bucket", "term"])
            .groupBy("doc_id")
            .agg(F.sum(F.lit(weight * idf) * F.col("likeness") * part).alias("score"))
        )

    # -- combination -------------------------------------------------------

    def _bool(self, clause: C.Bool, weight: float, only: DataFrame | None) -> DataFrame:
        """Union of all matches, tagged by child, then one aggregation.

        Numeric children are conditions on the document table. With a required
        word clause they are tested on the documents that clause left; without
        one they take part in the union.
        """
        must, should, must_not = (
            [c for c in group if not self._wordless(c)] for group in (clause.must, clause.should, clause.must_not)
        )
        if not must and not should:
            return self._nothing()
        children, roles = [], []
        for role, group in (("must", must), ("should", should), ("not", must_not)):
            for child in group:
                factor = weight
                while isinstance(child, C.Boost):
                    child, factor = child.clause, factor * child.factor
                children.append((len(children), child, factor))
                roles.append(role)
        conditions = {s: self._numeric(c) for s, c, _ in children}
        numeric = [e for e in children if conditions[e[0]] is not None]
        worded = [e for e in children if conditions[e[0]] is None]
        if not worded:
            return self._scan(self.index.points, numeric, conditions, roles, bool(must)).select("doc_id", "score")

        anchor = self._anchor([c for s, c, _ in worded if roles[s] == "must"])
        if anchor is not None:
            if not anchor[0]:  # a required clause that nothing matches
                return self._nothing()
            only = anchor[1]
        parts = []
        plain = [e for e in worded if isinstance(e[1], C.Term)]
        if plain:
            parts.append(self._term_rows(plain))
        parts += [
            self._rows(c, f, only).select("doc_id", F.lit(s).alias("slot"), "score")
            for s, c, f in worded
            if not isinstance(c, C.Term)
        ]
        narrow_by_words = any(roles[s] == "must" for s, _, _ in worded)
        if numeric and not narrow_by_words:
            parts.append(self._numeric_rows(numeric, conditions))
            counted = children
        else:
            counted = worded
        needed = [s for s, _, _ in counted if roles[s] == "must"]
        rows = reduce(DataFrame.unionByName, parts)
        if len(children) > 1:
            rows = _semi(rows, only)
        found = self._combine(rows, roles, needed)
        if not numeric or not narrow_by_words:
            return found
        columns = self.index.points
        if only is not None:
            found = F.broadcast(found)
        joined = found.withColumnRenamed("score", "words").join(columns, "doc_id")
        scored = self._scan(joined, numeric, conditions, roles, True)
        return scored.select("doc_id", (F.col("words") + F.col("score")).alias("score"))

    def _wordless(self, clause: C.Clause) -> bool:
        """Whether a clause analyses to no word at all; such a clause asks for nothing."""
        if isinstance(clause, C.Boost):
            return self._wordless(clause.clause)
        if isinstance(clause, C.Bool):
            inner = (*clause.must, *clause.should, *clause.must_not)
            return bool(inner) and all(map(self._wordless, inner))
        return (
            isinstance(clause, (C.Term, C.Phrase)) and self._numeric(clause) is None and not self.words.get(clause.text)
        )

    def _anchor(self, required: list[C.Clause]) -> tuple[int, DataFrame] | None:
        """How many postings the rarest required words have, and the ids in them, if
        few: no other document can match, so the rows of common words need not be
        shuffled."""
        choices = [x for x in map(self._rarest, required) if x is not None]
        if not choices or min(choices)[0] > ANCHOR_DOCS:
            return None
        most, field, words = min(choices)
        ids = self._lookup(self.index.postings, field, words).select("doc_id") if words else self._nothing().select("doc_id")
        return most, ids

    def _rarest(self, clause: C.Clause) -> tuple[int, str, list[str]] | None:
        """Words of which a match of the clause has at least one, with the number of
        their postings: all words of a term clause, the rarest one of a phrase, the
        best of what a nested clause requires."""
        if isinstance(clause, C.Boost):
            return self._rarest(clause.clause)
        if isinstance(clause, C.Bool):
            inner = [self._rarest(c) for c in clause.must if not self._wordless(c)]
            return min((x for x in inner if x is not None), default=None)
        if not isinstance(clause, (C.Term, C.Phrase)) or self._numeric(clause) is not None or not self.words.get(clause.text):
            return None
        counts = sorted((self.doc_freq.get((clause.field, w), 0), w) for w in set(self.words[clause.text]))
        if isinstance(clause, C.Phrase):
            counts = counts[:1]
        known = [(n, w) for n, w in counts if n]
        return sum(n for n, _ in known), clause.field, [w for _, w in known]

    def _scan(self, rows, numeric, conditions, roles, required: bool) -> DataFrame:
        """Numeric children as one filter and one sum over document rows."""
        keep, score, optional = F.lit(True), F.lit(0.0), F.lit(False)
        for slot, _, factor in numeric:
            condition = conditions[slot]
            if roles[slot] == "not":
                keep = keep & ~condition
                continue
            if roles[slot] == "must":
                keep = keep & condition
            optional = optional | condition
            score = score + F.when(condition, F.lit(float(factor))).otherwise(0.0)
        if not required:
            keep = keep & optional
        return rows.filter(keep).withColumn("score", score)

    def _numeric_rows(self, numeric, conditions) -> DataFrame:
        entries = [
            F.when(
                conditions[s],
                F.struct(F.lit(s).alias("slot"), F.lit(float(f)).alias("score")),
            )
            for s, _, f in numeric
        ]
        met = F.filter(F.array(*entries), lambda e: e.isNotNull())
        any_met = reduce(Column.__or__, [conditions[s] for s, _, _ in numeric])
        return self.index.points.filter(any_met).select("doc_id", F.inline(met))

    def _combine(self, rows: DataFrame, roles: list[str], needed: list[int]) -> DataFrame:
        def by_slot(values) -> Column:
            return F.get(F.array(*[F.lit(v) for v in values]), F.col("slot"))

        refused = by_slot([r == "not" for r in roles])
        aggregates = [
            F.sum(F.when(~refused, F.col("score")).otherwise(0.0)).alias("score"),
            F.bool_or(refused).alias("refused"),
            F.bool_or(~refused).alias("wanted"),
        ]
        if len(needed) <= _MASK_BITS:
            bits = [1 << needed.index(s) if s in needed else 0 for s in range(len(roles))]
            seen = F.bit_or(by_slot(bits).cast("long"))
            complete = F.col("seen") == (1 << len(needed)) - 1
        else:
            slot = F.when(F.col("slot").isin(*needed), F.col("slot"))
            seen = F.size(F.collect_set(slot))
            complete = F.col("seen") == len(needed)
        return (
            rows.groupBy("doc_id")
            .agg(*aggregates, seen.alias("seen"))
            .filter(~F.col("refused") & F.col("wanted") & complete)
            .select("doc_id", "score")
        )


def match(index: LexicalIndex, clause: C.Clause) -> DataFrame:
    """Every document the clause matches, with its score."""
    return Matcher(index, clause).matches()
