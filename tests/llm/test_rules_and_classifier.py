import math
import random
import re

import numpy as np
import pytest

from marquee.llm import kneser_ney as kn
from marquee.llm import rule_ledger as rl
from samples import sentence


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = {w for w in windows if windows.count(w) > 1} if len(words) < 3000 else None
    covered = {i + k for i, w in enumerate(windows) if w in repeated for k in range(3)} if repeated is not None else None
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
        None if covered is None else len(covered),
    )


def test_ledger_equals_brute_force(docs, corpus):
    got = sorted((str(r["doc_id"]), *(r[m] for m in rl.MEASURES), r["base_failed"], r["kept"]) for r in rl.judged(docs).collect())
    expected = []
    for doc_id, text in corpus:
        m = measures(text)
        if m[5] is None:
            m = (*m[:5], next(g[6] for g in got if g[0] == str(doc_id)))
        base = m[0] < 50 or 100 * m[5] > 50 * m[0]
        bad = 10 * m[2] > m[0] or 100 * m[4] > 45 * m[3] or m[1] < 2 * m[0] or m[1] > 15 * m[0]
        expected.append((str(doc_id), *m, base, not base and not bad))
    assert got == sorted(expected)


def test_ablation_counts(docs):
    rows = rl.ledger(docs).cache()
    found = {r["rule"]: r for r in rl.ablation(rows).collect()}
    assert set(found) == {r.name for r in rl.RULES}
    mask, total = rl.POLICIES[rl.CURRENT], [r["failures"] for r in rows.collect()]
    for rule in rl.RULES:
        bit = 1 << rule.bit
        assert found[rule.name]["n_failed"] == sum(bool(f & bit) for f in total)
        assert found[rule.name]["n_kept"] == sum(f & mask == 0 for f in total)
        assert found[rule.name]["n_kept_without"] == sum(f & mask & ~bit == 0 for f in total)


def test_kept_rows_are_input_rows(docs, no_docs):
    kept = rl.kept_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == rl.judged(docs).where("kept").count()
    assert kept.exceptAll(docs).isEmpty()
    assert rl.judged(no_docs).isEmpty() and rl.kept_rows(no_docs).columns == no_docs.columns


def brute_model(texts):
    """Interpolated modified Kneser-Ney of order four, by dictionaries."""
    from collections import Counter, defaultdict

    grams = Counter()
    for t in texts:
        c = [0, 0, 0, *(int(kn.class_table()[min(ord(x), 0x3000)]) for x in t.lower())]
        grams.update(tuple(c[i - 3 : i + 1]) for i in range(3, len(c)))
    levels = [grams]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    steps = []
    for level in levels:
        n1, n2, n3, n4 = (sum(v == k for v in level.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
        d = [min(max(v, 0.05), k - 0.05) for k, v in enumerate(raw, 1)]
        total, left = Counter(), defaultdict(float)
        for g, v in level.items():
            total[g[:-1]] += v
            left[g[:-1]] += d[min(v, 3) - 1]
        steps.append((level, d, total, left))

    def p(gram):
        value = 1 / kn.CLASSES
        for order, (level, d, total, left) in enumerate(steps, 1):
            g = gram[4 - order :]
            if total[g[:-1]]:
                v = level[g]
                value = ((v - d[min(v, 3) - 1]) if v else 0) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * value
        return value

    def perplexity(t):
        c = [0, 0, 0, *(int(kn.class_table()[min(ord(x), 0x3000)]) for x in t.lower())]
        return math.exp(-sum(math.log(p(tuple(c[i - 3 : i + 1]))) for i in range(3, len(c))) / (len(c) - 3))

    return perplexity


def test_perplexity_equals_brute_force(spark):
    rng = random.Random(2)
    texts = [sentence(rng, rng.randint(1, 60)) for _ in range(30)] + ["Été, 12 – (x)\n", "日本"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = kn.train(kn.count_four_grams(df))
    total = np.exp(model.logs().astype(float)).reshape(-1, kn.CLASSES).sum(1)
    assert np.allclose(total, 1, atol=1e-3)
    other = ["zzz qqq", "the inn", "ünß"]
    scored = kn.scored(spark.createDataFrame([(t,) for t in texts + other], "text string"), model).collect()
    brute = brute_model(texts)
    for r in scored:
        assert r["perplexity"] == pytest.approx(brute(r["text"]), rel=1e-4)


def test_classifier_separates_held_out_documents(spark):
    rng = random.Random(3)
    good = [sentence(rng, rng.randint(60, 150)) for _ in range(400)]
    bad = ["".join(rng.choice("qxzjkvw#%*&") for _ in range(300)) for _ in range(40)]
    rows = [(i, t, "en", "a", "b") for i, t in enumerate(good + bad)] + [(1000, None, None, "a", "b"), (1001, "", "xx", "a", "b"), (None, good[0], None, "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity string, threshold string").drop("perplexity", "threshold")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(0, 300)] + [(5, 1, 0), (None, 1, 0), (390, 1, 1), (410, 0, None)], "doc_id long, quality int, toxic int"
    )
    got = {r["doc_id"]: r["kept"] for r in kn.judged(docs, labels).collect()}
    assert sum(got[i] for i in range(300, 400)) >= 97 and not any(got[i] for i in range(400, 440))
    assert got[1000] is False and got[1001] is False and got[None] is True
    kept = kn.kept_rows(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(got.values())


def test_without_trusted_text_all_texts_stay(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = kn.judged(docs.select("doc_id", "text", "lang"), none).collect()
    assert all(r["perplexity"] is None for r in got) and sum(r["kept"] for r in got) == docs.where("length(text) > 0").count()
    assert kn.judged(no_docs, none).isEmpty()


def exact_perplexity(texts):
    """Interpolated modified Kneser-Ney of order four over characters, by dictionaries."""
    from collections import Counter, defaultdict

    lead = [None] * 3
    levels = [Counter(tuple(c[i - 3 : i + 1]) for t in texts for c in [lead + list(t)] for i in range(3, len(c)))]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    steps = []
    for level in levels:
        n1, n2, n3, n4 = (sum(v == k for v in level.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
        d = [min(max(v, 0.05), k - 0.05) for k, v in enumerate(raw, 1)]
        total, left = Counter(), defaultdict(float)
        for g, v in level.items():
            total[g[:-1]] += v
            left[g[:-1]] += d[min(v, 3) - 1]
        steps.append((level, d, total, left))

    def p(gram):
        value = 1 / 0x110000
        for order, (level, d, total, left) in enumerate(steps, 1):
            g = gram[4 - order :]
            if total[g[:-1]]:
                v = level[g]
                value = ((v - d[min(v, 3) - 1]) if v else 0) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * value
        return value

    def perplexity(t):
        c = lead + list(t)
        return math.exp(-sum(math.log(p(tuple(c[i - 3 : i + 1]))) for i in range(3, len(c))) / len(t))

    return perplexity


def test_real_characters_equal_brute_force(spark):
    from marquee.llm import character_grams as cg

    rng = random.Random(6)
    texts = [sentence(rng, rng.randint(1, 60)) for _ in range(30)] + ["Été, 12 – (x)\n", "日本語 𝒳", "слово Λόγος\0"]
    other = ["zzz qqq", "the inn", "ünß 99", "本日", "волос", "x"]
    table = lambda rows: spark.createDataFrame([(t,) for t in rows], "text string").repartition(3)
    model = cg.train(table(texts))
    got = cg.scored(table([*texts, *other, "", None]), model, block_chars=900).collect()
    assert len(got) == len(texts) + len(other) + 2
    brute = exact_perplexity(texts)
    for r in got:
        assert r["perplexity"] == (pytest.approx(brute(r["text"]), rel=1e-5) if r["text"] else None)


def test_junk_of_another_script_is_told_apart(spark):
    rng = random.Random(7)
    words = ["слово", "книга", "читать", "город", "вечером", "дорога", "письмо"]
    good = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(260)]
    junk = ["".join(rng.choice("абвгдежзийклмнопрстуфхцчшщыэюя") for _ in range(300)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "ru") for i, t in enumerate(good + junk)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(220)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in kn.judged(docs, labels).collect()}
    assert sum(got[i] for i in range(220, 260)) >= 38 and not any(got[i] for i in range(260, 280))


def test_small_languages_have_quantiles_of_their_own(spark):
    rows = [("en", 5.0 + i / 1000) for i in range(400)] + [("fr", 9.0), ("fr", 8.0), (None, 3.0)]
    got = {r["lang"]: r["threshold"] for r in kn.thresholds(spark.createDataFrame(rows, "lang string, perplexity double")).collect()}
    assert got["fr"] == pytest.approx(9 * kn.MARGIN) and got[""] == pytest.approx(3 * kn.MARGIN)
    assert got["en"] < 5.5 * kn.MARGIN and set(got) == {"en", "fr", "", None}


def test_places_of_four_grams_take_four_bytes_a_character():
    from marquee.llm import character_grams

    texts = ["abcabc" * 200_000, "", "xyz" * 300_000, "abc"]  # several groups
    a, b, places = character_grams.four_grams(texts)
    assert sum(at.nbytes for at, _ in places) == 4 * sum(map(len, texts))
    assert [n for _, lengths in places for n in lengths] == list(map(len, texts))
    last = np.concatenate([b[at] & character_grams.MASK for at, _ in places]) - 2
    assert "".join(map(chr, last)) == "".join(texts)
