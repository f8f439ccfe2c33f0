import hashlib
import random
import re

import pytest

from marquee.llm import decontamination
from samples import sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items):
    """Every window of every item against every place of every document."""
    windows = []
    for item_id, text in items:
        w = words_of(text)
        if 0 < len(w) < 10:
            windows.append((item_id, tuple(w)))
        windows += [(item_id, tuple(w[i : i + 10])) for i in range(len(w) - 9)]
    out = []
    for doc_id, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for item_id, win in windows:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    if item_id is not None:
                        found.add(item_id)
        ids = ",".join(sorted(str(i) for i in found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    items = [(i, sentence(rng, rng.randint(12, 40))) for i in range(12)]
    items += [(20, "Short Item Text"), (21, "one"), (22, None), (23, ""), (24, "!!! ..."), (None, sentence(rng, 15)), (3, items[3][1]), (25, items[0][1])]
    docs = [(i, sentence(rng, 80)) for i in range(10)]
    docs += [(10 + i, f"{sentence(rng, 20)} {items[i][1].upper()} {sentence(rng, 20)}") for i in range(6)]
    half = items[7][1].split()
    docs += [(30, " ".join(half[:9]) + " zz " + " ".join(half[9:])), (31, "SHORT item-text, one!"), (32, None), (33, ""), (34, "Ünï cödé " + items[8][1].replace(" ", "  \n ")), (35, items[9][1] + " " + items[9][1])]
    docs += [(36, docs[12][1]), (36, docs[12][1]), (None, items[10][1]), (37, sentence(rng, 20000) + " " + items[11][1])]
    docs.append((38, items[-1][1]))  # the row whose id is null
    return docs, items


def digest(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n_words": __import__("pyspark.sql.functions", fromlist=["lit"]).lit("clash"), "item_ids": __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1)})
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.decontamination_report(d.repartition(3), b, **kw).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_equals_brute_force(spark, cases):
    docs, items = cases
    assert digest(spark, docs, items) == brute(docs, items)


def test_blocks_of_patterns_give_the_same(spark, cases):
    docs, items = cases
    assert digest(spark, docs, items, block_bytes=300) == brute(docs, items)


def test_empty_benchmark_and_empty_table(spark, cases):
    docs, _ = cases
    assert digest(spark, docs, []) == brute(docs, [])
    assert digest(spark, [], cases[1]) == []


def test_spans_point_into_the_original(spark):
    text = "Intro words here. THE quick, brown fox jumps over the lazy dog again and again! tail"
    item = "the quick brown fox jumps over the lazy dog again"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    row = decontamination.contamination(d, b).first()
    assert row["n_hit"] == 10 and row["item_ids"] == [7]
    (span,) = row["spans"]
    assert text[span["start"] : span["end"]] == "THE quick, brown fox jumps over the lazy dog again"
