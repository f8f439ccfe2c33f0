import random

import pytest

from samples import sentence


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): copies, near copies, shared passages, junk, odd cases."""
    rng = random.Random(11)
    base = [sentence(rng, rng.randint(60, 200)) for _ in range(40)]
    passage = sentence(rng, 120)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(12)]
    for i in range(25):  # near copies of one text, one or two words changed
        words = base[1].split()
        for _ in range(rng.randint(1, 2)):
            words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((200 + i, " ".join(words)))
    rows += [(300 + i, f"{base[i]} {passage} {sentence(rng, 30)}") for i in range(2, 10)]
    rows.append((400, " ".join(base[3].split()[:50] * 3)))
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "Of."), (504, "a b c d"), (505, "a b c d e f"), (506, "A B c d e f")]
    rows += [(510, "x" * 5000), (511, "### %%% *** " * 60), (512, "line one\nline one\nline one\n" * 30), (513, "é" * 400 + "日本語" * 100)]
    rows += [(7, base[7]), (7, base[7]), (None, base[8]), (None, None), (None, "only here " * 30)]
    rows.append((600, " ".join(sentence(rng, 30_000).split())))
    return rows


@pytest.fixture
def docs(spark, corpus):
    """With columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, h1 string, key string"
    return spark.createDataFrame(
        [(i, t, ("en", "fr", None)[k % 3], "s", len(t or ""), "r", "h", "k") for k, (i, t) in enumerate(corpus)], schema
    ).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
