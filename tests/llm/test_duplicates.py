import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from marquee.llm import cap_filters as cf
from marquee.llm import order_minhash as om
from marquee.llm import repeated_bytes as rb
from marquee.llm.components import components
from marquee.llm.deep_shallow import common_prefix, sort


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(60)] + [(500, 501 + i) for i in range(50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links + links[:9], "a int, b int")).collect()}
    expected = roots(600, links)
    assert got == {x: expected[x] for link in links for x in link}
    assert components(spark.createDataFrame([], "a int, b int")).isEmpty()


def shingles(text):
    words = (text or "").lower().split()
    count, found = Counter(), set()
    for i in range(max(len(words) - 4, 1)):
        w = tuple(words[i : i + 5])
        found.add((w, count[w]))
        count[w] += 1
    return found


def brute_classes(corpus):
    sets = [shingles(t) for _, t in corpus]
    links = []
    for i in range(len(corpus)):
        for j in range(i):
            same = (corpus[i][1] or "") == (corpus[j][1] or "")
            long_enough = min(len(sets[i]), len(sets[j])) > 1
            if same or long_enough and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links.append((i, j))
    found = roots(len(corpus), links)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(corpus):
        ids[found[i]].append(doc_id)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(least[found[i]], len(ids[found[i]])) for i in range(len(corpus))]


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_equal_brute_force(docs, corpus, no_docs, monkeypatch, block):
    monkeypatch.setattr(om, "BLOCK", block)
    got = sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"], r["kept"]) for r in om.judged(docs).collect())
    expected = sorted((str(i), str(c), n, i == c) for (i, _), (c, n) in zip(corpus, brute_classes(corpus)))
    assert got == expected
    kept = om.kept_rows(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty()
    assert kept.count() == len(set(brute_classes(corpus)) - {(None, 1)}) + sum(c is None for c, _ in brute_classes(corpus))
    assert om.judged(no_docs).isEmpty() and om.kept_rows(no_docs).isEmpty()


def test_alignment_against_table():
    rng = random.Random(2)
    for _ in range(300):
        a = np.array([rng.randrange(40) for _ in range(rng.randint(1, 30))], np.uint64)
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.randrange(40)) if rng.random() < 0.5 or len(b) < 2 else b.pop(rng.randrange(len(b)))
        b = np.array(b, np.uint64)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        true = best[-1][-1] / (len(a) + len(b) - best[-1][-1])
        assert om.aligned(a, b, 0.0) == pytest.approx(true)
        assert (om.aligned(a, b, 0.8) >= 0.8) == (true >= 0.8)


def test_order_matters_for_sketches():
    mers = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seeds = om._seeds[: om.SKETCHES]
    assert (om.sketches(mers, seeds, 5) == om.sketches(mers.copy(), seeds, 5)).all()
    assert (om.sketches(mers, seeds, 5) == om.sketches(mers[::-1].copy(), seeds, 5)).mean() < 0.1


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        for _ in range(15):
            base = rng.standard_normal(64)
            for k in range(rng.integers(1, 6)):
                rows.append((label, (base + rng.standard_normal(64) * (0.0 if k == 1 else 0.17)).astype(np.float32).tolist()))
        hub = rng.standard_normal(64)
        rows += [(label, (hub + rng.standard_normal(64) * 0.05).astype(np.float32).tolist()) for _ in range(40)]
    rows += [(0, [0.0] * 64), (0, None), (None, rows[0][1]), (0, [float("nan")] * 64), (0, [float("inf")] + [1.0] * 63), (0, [1.0] * 3), (0, [2.0] * 3)]
    rows += [(0, [None] + [1.0] * 63), (0, []), (1, [3e38] * 64), (1, [1e-30] * 64)]
    return [(i, label, x) for i, (label, x) in enumerate(rows)] + [(3, *rows[3]), (None, *rows[5])]


@pytest.mark.parametrize("block", [512, 8])
def test_vector_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cf, "BLOCK", block)
    rows = vectors()

    def sound(label, x):
        return label is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x)

    links = []
    for i, (_, l, x) in enumerate(rows):
        for j, (_, m, y) in enumerate(rows[:i]):
            if sound(l, x) and sound(m, y) and l == m and len(x) == len(y):
                a, b = np.array(x, float), np.array(y, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                    links.append((i, j))
    found, count = roots(len(rows), links), Counter(x for p in links for x in p)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[found[i]].append(r[0])
    expected = []
    for i, r in enumerate(rows):
        least = min((x for x in ids[found[i]] if x is not None), default=None)
        expected.append((str(r[0]), count[i], str(least), r[0] == least))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, links string, root int")
    got = [(str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in cf.vector_links(df).collect()]
    assert sorted(got) == sorted(expected)
    assert cf.vector_links(df.limit(0)).isEmpty()


def test_filters_meet_at_the_limit():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((1500, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * z
    for directions in (10**5, 10**7):
        shared = [len(np.intersect1d(a, b)) for a, b in zip(cf.decode(x, directions), cf.decode(y, directions))]
        assert min(shared) > 0


def brute_spans(texts, window):
    """Of each text: maximal runs covered by strings of the window's length that start twice."""
    starts = Counter()
    for t in texts:
        starts.update(t[i : i + window] for i in range(len(t) - window + 1))
    result = []
    for t in texts:
        covered = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if starts[t[i : i + window]] > 1:
                covered[i : i + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(int)))))
        result.append((len(t), int(covered.sum()), len(edges) // 2, hashlib.sha256(np.frombuffer(t, np.uint8)[~covered[:-1]].tobytes()).hexdigest()))
    return result


@pytest.mark.parametrize("group, window", [(2048, 400), (2, 400), (2048, 130), (2, 130)])
def test_repeated_bytes_equal_brute_force(spark, corpus, no_docs, monkeypatch, group, window):
    monkeypatch.setattr(rb, "GROUP", group)
    monkeypatch.setattr(rb, "SPREAD", 16)
    some = [r for r in corpus if r[0] != 600] + [(700, "ab" * 700), (701, ("ab" * 300) + "c" + "ab" * 300)]
    common = "the very common line of a licence that nearly all of these documents carry somewhere inside of them, word by word"
    rng = random.Random(9)
    for i in range(12):
        before, after = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(2))
        some.append((800 + i, before[: 300 - 9 * i] + common + after))
    docs = spark.createDataFrame([(*r, "s") for r in some], "doc_id long, text string, spans string").repartition(3)
    got = [(str(r[0]), *r[1:]) for r in rb.judged(docs, window).collect()]
    expected = [(str(i), *x) for (i, _), x in zip(some, brute_spans([(t or "").encode() for _, t in some], window))]
    assert sorted(got) == sorted(expected)
    assert rb.judged(no_docs).isEmpty()


def test_long_texts_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(rb, "CHUNK", 700)
    rng = random.Random(5)
    shared = "".join(rng.choice("abc ") for _ in range(900))
    texts = ["".join(rng.choice("abc ") for _ in range(2000)) + shared + "".join(rng.choice("abc ") for _ in range(k)) for k in (0, 333, 1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in rb.judged(docs).orderBy("doc_id").collect()]
    assert got == brute_spans([t.encode() for t in texts], 400)


def test_judged_rows_show_what_is_left(spark):
    shared = "".join(random.Random(6).choice("abc ") for _ in range(500))
    docs = spark.createDataFrame([(1, "é one " + shared + " end é"), (2, shared), (3, "alone"), (4, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in rb.judged(docs, with_text=True).collect()}
    assert [rows[i]["text"] for i in (1, 2, 3, 4)] == ["é one  end é", "", "alone", ""]
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"] for r in rows.values())


def test_trimmed_rows_keep_columns(docs, corpus, no_docs):
    rows = rb.trimmed_rows(docs, 250)
    assert rows.columns == docs.columns and rows.count() == len(corpus)
    spans = {x: n for (x, _), n in zip(corpus, brute_spans([(t or "").encode() for _, t in corpus if True][:60], 250)) if x is not None}
    by_id = {r["doc_id"]: r for r in rows.collect()}
    assert by_id[500]["text"] is None and by_id[503]["text"] == "Of." and by_id[503]["n_chars"] == 3
    assert by_id[100]["text"] == "" and by_id[100]["n_chars"] == 0 and spans
    assert all(r["n_chars"] == len(r["text"]) for r in by_id.values() if r["text"] is not None)
    assert rb.trimmed_rows(no_docs).columns == no_docs.columns


def test_deep_shallow_order():
    rng = random.Random(3)
    for _ in range(200):
        base = bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 5, 20, 150])))
        strings = [base[: rng.randint(0, len(base))] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 40))]
        order, prefix = sort(strings, rng.choice([0, 8, 16, 96]))
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
        assert prefix == [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]


def test_texts_of_one_k_mer(spark):
    texts = ["One two three", "one  TWO three", "one two three four", "one two", "A b c d e", "a b\nc d E", "a b c d e", "e d c b a", "Of.", "of.", "", " ", None, "one two three"]
    rows = list(enumerate(texts))
    words = [tuple((t or "").lower().split()) or (t or "") for t in texts]  # texts without words are compared as they are
    expected = {i: (words.index(w), words.count(w), words.index(w) == i) for i, w in enumerate(words)}
    got = om.judged(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: (r["class_id"], r["class_size"], r["kept"]) for r in got} == expected
