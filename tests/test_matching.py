import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.operators.clauses import (
    Bool, Boost, Fuzzy, MatchAll, Phrase, Prefix, Range, Regex, Term, Wildcard,
)
from marquee.operators.batch import batch_top_k
from marquee.operators.matching import edit_distance, like_pattern, match
from marquee.operators.topk import top_k
from marquee.plans.search import lexical_search, top_rated

ROWS = [
    {"movie_name": "The Menu", "genre": "Short,Comedy,Drama", "year": "2023", "rating": "8.0", "votes": "10",
     "plot": "a cat and a dog run", "cast": "Ann Lee"},
    {"movie_name": "Olla", "genre": "Drama", "year": "2019", "rating": "6.8", "votes": "1,896",
     "plot": "the dog and the cat sleep far from a dog", "cast": "Bob Lee"},
    {"movie_name": "Boobs in Arms", "genre": "Comedy,War", "year": "1940.0", "rating": "7.8", "votes": "557",
     "plot": "cat dog cat dog", "cast": "Moe Howard"},
    {"movie_name": "Nothing", "rating": "10.0"},
]


@pytest.fixture(scope="module")
def index(make_index):
    return make_index(*ROWS)


def ids(index, clause):
    return sorted(r["doc_id"] for r in match(index, clause).collect())


def scores(index, clause):
    return {r["doc_id"]: r["score"] for r in match(index, clause).collect()}


def test_bm25_by_hand(index):
    # Field plot: lengths 6, 10, 4 and 1 ("unknown"), so N = 4 and the mean is 5.25.
    # "cat" is in three documents, with frequencies 1, 1 and 2.
    idf = math.log(1 + (4 - 3 + 0.5) / (3 + 0.5))
    expected = {
        d: idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl / 5.25)) for d, tf, dl in [(0, 1, 6), (1, 1, 10), (2, 2, 4)]
    }
    assert idf == pytest.approx(0.3566749, abs=1e-6)
    assert expected[2] == pytest.approx(0.3566749 * 2 / (2 + 1.2 * (0.25 + 3 / 5.25)), abs=1e-6)
    assert scores(index, Term("CAT", "plot")) == pytest.approx(expected)
    assert scores(index, Boost(Term("cat", "plot"), 3)) == pytest.approx({d: 3 * s for d, s in expected.items()})
    assert scores(index, Term("cat cat", "plot")) == pytest.approx({d: 2 * s for d, s in expected.items()})


def test_default_field_and_sentinels(index):
    assert ids(index, Term("menu arms")) == [0, 2]
    assert ids(index, Term("unknown")) == [0, 1, 2, 3]
    assert ids(index, Term("0")) == [3]
    assert ids(index, Term("1940")) == [2]
    assert ids(index, Term("!!")) == []
    assert ids(index, Term("absentword")) == []


def test_numeric_clauses(index):
    assert ids(index, Term("2019", "year")) == [1]
    assert ids(index, Phrase("2019", "year")) == [1]
    assert ids(index, Term("6.8", "rating")) == [1]
    assert ids(index, Range("rating", 6.8, 8.0, False, False)) == [0, 1, 2]
    assert ids(index, Range("votes", 500, None)) == [1, 2]
    assert ids(index, Range("votes", None, None)) == [0, 1, 2, 3]
    assert scores(index, Range("rating", 8, None)) == {0: 1.0, 3: 1.0}
    for bad in (lambda: Term("abc", "year"), lambda: Term("2010.5", "votes"), lambda: Range("rating", "x", None)):
        with pytest.raises(ValueError):
            bad()


def test_text_range_honours_ends(index):
    assert ids(index, Range("plot", "cat", "dog")) == [0, 1, 2]
    assert ids(index, Range("plot", "run", "sleep", False, True)) == [1]
    assert ids(index, Range("plot", "run", "sleep", True, False)) == [0]


def test_prefix_wildcard_regex(index):
    assert ids(index, Prefix("SL", "plot")) == [1]
    assert ids(index, Wildcard("s?e*p", "plot")) == [1]
    assert ids(index, Wildcard("d?", "plot")) == []
    assert ids(index, Regex("r.n|sleep", "plot")) == [0, 1]
    assert ids(index, Regex("ru", "plot")) == []
    assert like_pattern(r"a%b\*c*?") == (r"a\%b*c%_", "a%b*c")
    for first in ("*x", "?x"):
        with pytest.raises(ValueError):
            Wildcard(first)


def osa(a, b):
    """Edit distance with swaps of neighbours, by the usual recurrence."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@pytest.mark.parametrize("limit", [0, 1, 2])
def test_edit_distance_against_recurrence(spark, limit):
    rng = random.Random(limit)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for text in ("abca", "cab", "aabbcc"):
        got = df.select("w", edit_distance(F.col("w"), text, limit).alias("e")).collect()
        for r in got:
            true = osa(r["w"], text)
            assert (r["e"] if r["e"] <= limit else None) == (true if true <= limit else None)


def test_fuzzy(index):
    assert ids(index, Fuzzy("slepe", "plot", max_edits=1)) == [1]
    assert ids(index, Fuzzy("kat", "plot", max_edits=1)) == [0, 1, 2]
    assert ids(index, Fuzzy("zzzzzz", "plot")) == []
    exact, near = scores(index, Fuzzy("cat", "plot", 0)), scores(index, Fuzzy("kat", "plot", 1))
    assert near == pytest.approx({d: s * 2 / 3 for d, s in exact.items()})
    few, every = Fuzzy("cog", "plot", 2, 1), Fuzzy("cog", "plot", 2, None)
    assert set(ids(index, few)) <= set(ids(index, every))


def test_phrases(index):
    assert ids(index, Phrase("cat dog", "plot")) == [2]
    assert ids(index, Phrase("dog and", "plot")) == [1]
    assert ids(index, Phrase("cat and a dog", "plot")) == [0]
    assert ids(index, Phrase("dog cat dog", "plot")) == [2]
    assert ids(index, Phrase("cat missing", "plot")) == []
    assert ids(index, Phrase("interstellar")) == []
    assert ids(index, Phrase("menu")) == [0]
    for bad in (lambda: Phrase("cat dog"), lambda: match(index, Phrase("cat-dog"))):
        with pytest.raises(ValueError):
            bad()
    # "cat dog" occurs twice in document 2.
    idf = math.log(1 + 1.5 / 3.5) * 2
    assert scores(index, Phrase("cat dog", "plot"))[2] == pytest.approx(idf * 2 / (2 + 1.2 * (0.25 + 0.75 * 4 / 5.25)))


def test_phrase_of_common_words(index, monkeypatch):
    """The same with no word rare enough to narrow the others down."""
    clauses = [Phrase("dog cat dog", "plot"), Phrase("dog cat", "plot", slop=2)]
    narrowed = [scores(index, c) for c in clauses]
    monkeypatch.setattr("marquee.operators.matching.ANCHOR_DOCS", 0)
    assert [scores(index, c) for c in clauses] == narrowed


def test_nested_bool_under_a_rare_word(index):
    inner = Bool(should=[Phrase("dog and", "plot"), Term("cat", "plot")], must_not=[Term("war", "genre")])
    assert ids(index, Bool(must=[inner])) == [0, 1]
    assert ids(index, Bool(must=[Term("olla", "name"), inner])) == [1]
    assert ids(index, Bool(must=[Term("arms", "name"), inner])) == []
    both = scores(index, Bool(must=[Term("olla", "name"), inner, Range("votes", 5, None)]))
    assert both == pytest.approx({1: scores(index, Term("olla", "name"))[1] + scores(index, inner)[1] + 1})


def test_phrase_slop(index):
    assert ids(index, Phrase("cat dog", "plot", slop=2)) == [0, 2]
    assert ids(index, Phrase("cat dog", "plot", slop=1)) == [2]
    assert ids(index, Phrase("dog cat", "plot", slop=2)) == [1, 2]


def test_bool_rules(index):
    drama, comedy = Term("drama", "genre"), Term("comedy", "genre")
    assert ids(index, Bool(must=[drama, comedy])) == [0]
    assert ids(index, Bool(should=[drama, comedy])) == [0, 1, 2]
    assert ids(index, Bool(must=[drama], should=[comedy])) == [0, 1]
    assert ids(index, Bool(must=[drama], must_not=[comedy])) == [1]
    assert ids(index, Bool(must_not=[comedy])) == []
    assert ids(index, Bool(must=[MatchAll()], must_not=[comedy])) == [1, 3]
    assert ids(index, Bool(must=[drama, Range("rating", 7, None)])) == [0]
    assert ids(index, Bool(must=[Range("rating", 7, None)], must_not=[Term("war", "genre")])) == [0, 3]
    assert ids(index, Bool(should=[Range("year", 1900, 1950), Term("olla", "name")])) == [1, 2]
    assert ids(index, Bool(must=[Bool(should=[drama, Term("war", "genre")])], must_not=[Prefix("sho", "genre")])) == [1, 2]
    assert ids(index, Bool(must=[Term("tt0", "movie_id")])) == []
    both = scores(index, Bool(must=[drama, Range("rating", 7, None)], should=[Boost(comedy, 2)]))
    parts = scores(index, drama)[0] + 1 + 2 * scores(index, comedy)[0]
    assert both == pytest.approx({0: parts})


def test_many_required_clauses(index):
    clauses = [Term("cat", "plot")] * 70
    assert ids(index, Bool(must=clauses)) == [0, 1, 2]
    assert ids(index, Bool(must=[*clauses, Term("sleep", "plot")])) == [1]


@pytest.mark.parametrize("anchor_docs", [0, 1_000_000])
def test_bool_against_sets(make_index, anchor_docs, monkeypatch):
    """Random clause trees against set arithmetic over brute-force leaves."""
    monkeypatch.setattr("marquee.operators.matching.ANCHOR_DOCS", anchor_docs)
    rng = random.Random(5)
    words = ["ant", "bee", "cow", "doe", "elk"]
    rows = [
        {"plot": " ".join(rng.choices(words, k=rng.randint(1, 6))), "year": str(rng.randint(1990, 1999))}
        for _ in range(60)
    ]
    index = make_index(*rows)
    everything = set(range(60))

    def leaf():
        if rng.random() < 0.6:
            word = rng.choice(words)
            return Term(word, "plot"), {i for i, r in enumerate(rows) if word in r["plot"].split()}
        low = rng.randint(1990, 1999)
        return Range("year", low, low + 3), {i for i, r in enumerate(rows) if low <= int(r["year"]) <= low + 3}

    def tree(depth):
        if depth == 0:
            return leaf()
        groups = [[tree(rng.choice([0, depth - 1])) for _ in range(rng.randint(0, 2))] for _ in range(3)]
        must, should, no = groups
        if must:
            found = set.intersection(*(s for _, s in must))
        else:
            found = set().union(*(s for _, s in should))
        found = (found & everything) - set().union(*(s for _, s in no))
        return Bool(*[[c for c, _ in g] for g in groups]), found

    for _ in range(8):
        clause, expected = tree(2)
        assert ids(index, clause) == sorted(expected), clause


def test_top_k_order_and_hits(index):
    hits = top_k(match(index, MatchAll()), 3).orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"]) for r in hits] == [(1, 0), (2, 1), (3, 2)]
    assert top_k(match(index, MatchAll()), 100).count() == 4
    best = lexical_search(index, "menu", 5).collect()
    assert [r["name"] for r in best] == ["The Menu"] and best[0]["movie_id"] == "tt0"
    assert len(best[0]) == 14
    assert [r["name"] for r in top_rated(index).collect()] == ["The Menu", "Nothing"]
    assert lexical_search(index, "absentword").collect() == []


def test_other_scoring_settings(index):
    plain = scores(index.with_scoring(b=0.0, k1=1.0), Term("cat", "plot"))
    idf = math.log(1 + 1.5 / 3.5)
    assert plain == pytest.approx({0: idf / 2, 1: idf / 2, 2: idf * 2 / 3})
    assert scores(index.with_scoring(norms="byte4"), Term("cat", "plot")) == pytest.approx(
        scores(index, Term("cat", "plot"))
    )


@pytest.fixture(scope="module")
def skewed(make_index):
    """Words with very uneven frequencies: "w0" is in nearly every document."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) ** 1.3 for i in range(60)]
    rows = [{"plot": " ".join(rng.choices(vocabulary, weights, k=rng.randint(3, 30)))} for _ in range(400)]
    queries = [
        (q, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 12)))) for q in range(30)
    ] + [(30, "w0 w0 w1"), (31, "nosuchword"), (32, "w59 w58 w0")]
    return make_index(*rows), rows, queries


def brute_force(rows, text, k):
    docs = [Counter(r["plot"].split()) for r in rows]
    lengths = [sum(d.values()) for d in docs]
    mean = sum(lengths) / len(docs)
    found = {}
    for word, times in Counter(text.split()).items():
        df = sum(word in d for d in docs)
        idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
        for i, d in enumerate(docs):
            if word in d:
                part = d[word] / (d[word] + 1.2 * (0.25 + 0.75 * lengths[i] / mean))
                found[i] = found.get(i, 0) + times * idf * part
    best = sorted(found.items(), key=lambda e: (-round(e[1], 6), e[0]))[:k]
    return [(i, pytest.approx(s, abs=2e-6)) for i, s in best]


@pytest.mark.parametrize("prune", [True, False])
def test_batch_against_brute_force(spark, skewed, prune, monkeypatch):
    monkeypatch.setattr("marquee.operators.batch.SEED_DOCS_PER_HIT", 5)
    index, rows, queries = skewed
    asked = spark.createDataFrame(queries, "qid long, text string")
    got = batch_top_k(index, asked, 4, field="plot", prune=prune).orderBy("qid", "rank").collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r["qid"], []).append((r["doc_id"], r["score"]))
    for qid, text in queries:
        assert by_query.get(qid, []) == brute_force(rows, text, 4), text


def test_batch_more_hits_than_documents(spark, skewed):
    index, rows, queries = skewed
    asked = spark.createDataFrame([(1, "w0 w3"), (2, "w58")], "qid long, text string")
    got = batch_top_k(index, asked, 1000, field="plot", prune=True).groupBy("qid").count().collect()
    expected = {q: len(brute_force(rows, t, 1000)) for q, t in [(1, "w0 w3"), (2, "w58")]}
    assert {r["qid"]: r["count"] for r in got} == {q: n for q, n in expected.items() if n}


def test_required_phrases_and_nested_clauses_narrow(index):
    absent = Phrase("nowhere tobefound", "plot")
    for required in (absent, Bool(must=[absent]), Bool(must=[Bool(must=[Term("nowhere", "plot")])])):
        found = match(index, Bool(must=[required], should=[Term("the")]))
        assert "postings" not in found._jdf.queryExecution().optimizedPlan().toString() and found.isEmpty()
