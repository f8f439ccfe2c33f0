"""What a build derives from analysed documents: right, and without a shuffle per token."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from marquee.functions.scoring import B, K1
from marquee.operators import postings as P
from marquee.operators.cleaning import clean_catalog
from marquee.sources.storage import write_in_order

ROWS = [
    {"movie_id": f"m{i}", "movie_name": f"the film {i % 7}", "plot": " ".join(["the sea", "deep"] * (i % 5) + [f"w{i % 11}"]), "genre": "" if i % 3 else "Drama,The"}
    for i in range(300)
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_and_ranges_are_made_without_a_shuffle_of_tokens(spark, make_raw, tmp_path):
    docs = P.analyze(clean_catalog(make_raw(*ROWS)))
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.schema(docs.schema).parquet(f"{tmp_path}/docs")
    postings = P.postings(docs)
    assert "Exchange" not in _plan(postings)
    seen = {(r["field"], r["term"], r["doc_id"]): (r["tf"], r["dl"], r["positions"]) for r in postings.collect()}
    wanted = {}
    for doc in docs.collect():
        body = list(doc["tokens_year"])
        for field in P.TEXT_FIELDS:
            words = doc[f"tokens_{field}"]
            body += words
            for word, times in Counter(words).items():
                wanted[field, word, doc["doc_id"]] = (times, len(words), [i for i, w in enumerate(words) if w == word])
        for word, times in Counter(body).items():
            wanted[P.BODY, word, doc["doc_id"]] = (times, len(body), None)
    assert seen == wanted and postings.count() == len(wanted)

    rows = postings.withColumn("term_bucket", F.lit(0)).orderBy("field", "term", "doc_id")
    written = write_in_order(rows, f"{tmp_path}/postings", ["field", "term_bucket"])
    average = {f: 3.0 for f in (*P.TEXT_FIELDS, P.BODY)}
    ranges = P.range_stats(written, 6, average)
    assert "Exchange" not in _plan(ranges)
    found = ranges.groupBy("field", "term", "doc_range").agg(F.sum("n"), F.max("max_tf"), F.min("min_dl"), F.max("max_part")).collect()
    groups = {}
    for (field, term, doc), (tf, dl, _) in wanted.items():
        groups.setdefault((field, term, doc >> 6), []).append((tf, dl))
    assert len(found) == len(groups)
    for field, term, doc_range, n, max_tf, min_dl, part in found:
        group = groups[field, term, doc_range]
        assert (n, max_tf, min_dl) == (len(group), max(t for t, _ in group), min(d for _, d in group))
        assert abs(part - max(t / (t + K1 * (1 - B + B * d / 3.0)) for t, d in group)) < 1e-12
    df = {(r["field"], r["term"]): r["df"] for r in P.term_stats(ranges).collect()}
    assert df == Counter((f, t) for f, t, _ in wanted)
