"""Postings kept as blocks: the same postings, in fewer rows, and ranges of common words only."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import postings as P
from marquee.operators.clauses import Term
from marquee.operators.cleaning import clean_catalog
from marquee.operators.matching import match
from marquee.operators.pruned import pruned_top_k
from marquee.operators.topk import top_k

LONG = " ".join(["sea"] * 40_000 + ["end"])
ROWS = [
    {"movie_id": f"m{i}", "movie_name": f"film {i % 7}", "genre": "Drama",
     "plot": LONG if i == 77 else " ".join(["the sea", "deep"] * (i % 4) + ([f"rare{i % 90}"] if i % 2 else []))}
    for i in range(400)
]


def _rows(df):
    return sorted(tuple(r) for r in df.select("rank", "doc_id", "score").collect())


def test_blocks_hold_every_posting_in_fewer_rows(spark, make_raw):
    docs = P.analyze(clean_catalog(make_raw(*ROWS)))
    blocks = P.posting_blocks(docs).cache()
    found = P.open_blocks(blocks).filter(F.col("field") == "plot").collect()
    wanted = {}
    for i, row in enumerate(ROWS):
        words = (row["plot"] or "Unknown").lower().split()
        for place, word in enumerate(words):
            wanted.setdefault((word, i), (len(words), []))[1].append(place)
    assert len(found) == len(wanted)
    assert all(wanted[r["term"], r["doc_id"]] == (r["dl"], r["positions"]) and r["tf"] == len(r["positions"]) for r in found)
    assert blocks.count() * 5 < P.open_blocks(blocks).count()


def test_index_keeps_blocks_and_ranges_of_common_words(make_index):
    index = make_index(*ROWS)
    limit = 1 << index.range_bits
    common = {(r["field"], r["term"]) for r in index.terms.filter(F.col("df") > limit).collect()}
    assert ("plot", "sea") in common and ("plot", "rare1") not in common
    ranges = index.ranges.groupBy("field", "term", "doc_range").agg(F.sum("n"), F.max("max_tf"), F.min("min_dl"), F.max("max_part"))
    found = {(r[0], r[1], r[2]): tuple(r)[3:] for r in ranges.collect()}
    assert {k[:2] for k in found} == common
    groups = {}
    for r in index.postings.collect():
        if (r["field"], r["term"]) in common:
            groups.setdefault((r["field"], r["term"], r["doc_id"] >> index.range_bits), []).append((r["tf"], r["dl"]))
    assert set(groups) == set(found)
    for key, group in groups.items():
        n, tf, dl, part = found[key]
        mean = index.fields[key[0]][1]
        assert (n, tf, dl) == (len(group), max(t for t, _ in group), min(d for _, d in group))
        assert abs(part - max(t / (t + 1.2 * (0.25 + 0.75 * d / mean)) for t, d in group)) < 1e-9
    assert not [c for c in index.docs.columns if c.startswith("tokens_")]


def test_common_and_rare_words_together(make_index):
    index = make_index(*ROWS)
    for words, k in (("sea rare1", 3), ("rare1 rare3", 9), ("the deep sea", 20), ("end", 2)):
        for scored in (index, index.with_scoring(k1=0.5, b=0.9)):
            clause = Term(words, "plot")
            assert _rows(pruned_top_k(scored, clause, k)) == _rows(top_k(match(scored, clause), k))
