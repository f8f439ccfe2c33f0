"""A family of near copies costs a few links a text, not one per sketch."""

from __future__ import annotations

from marquee.llm import order_minhash


def test_a_large_family_has_few_links(spark, monkeypatch):
    words = [f"w{i}" for i in range(120)]
    rows = [(n, " ".join([*words[: n % 100], f"x{n}", *words[n % 100 + 1 :]])) for n in range(200)]
    docs = spark.createDataFrame([*rows, (900, "something else is said in this one here"), (901, "")], "doc_id long, text string")
    counted, real = [], order_minhash.components

    def components(links, *names):
        counted.append(links.distinct().count())
        return real(links, *names)

    monkeypatch.setattr(order_minhash, "components", components)
    found = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in order_minhash.judged(docs).collect()}
    assert all(found[n] == (0, 200) for n in range(200))
    assert found[900] == (900, 1) and found[901] == (901, 1)
    assert counted[0] < 2 * len(rows)


def test_word_hashes_kept_by_a_worker_stay_few():
    for n in range(250):
        order_minhash.k_mers(" ".join(f"word{n}x{i}" for i in range(1000)))
    assert len(order_minhash._hashes) <= 110_000
