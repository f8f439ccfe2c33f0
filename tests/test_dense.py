import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.functions.scoring import inner_product
from marquee.functions.text import tokenize
from marquee.functions.vectors import Encoder, HashedEncoder, embed, mean_pool
from marquee.operators.dense import blocked_top_k, inner_product_top_k, masked_mean_pool
from marquee.operators.topk import top_k_per_query


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-3, 4, size=(300, 8)).astype(float)
    vectors[200:] = vectors[100]  # a third of the rows are copies: many equal scores
    queries = rng.integers(-3, 4, size=(40, 8)).astype(float)

    def frame(rows, key):
        return spark.createDataFrame(
            [(i, r.tolist()) for i, r in enumerate(rows)], f"{key} long, embedding array<float>"
        ).repartition(5)

    return vectors, queries, frame(vectors, "doc_id"), frame(queries, "qid")


def flat_scan(vectors, queries, k):
    expected = []
    for q, query in enumerate(queries):
        ips = vectors @ query
        for rank, d in enumerate(sorted(range(len(vectors)), key=lambda i: (-ips[i], i))[:k], 1):
            expected.append((q, rank, d, ips[d]))
    return expected


@pytest.mark.parametrize("block", [2048, 60, 25])
def test_top_k_equals_flat_scan(tables, block):
    """Block sizes that send the queries, and (twice) the queries in parts."""
    vectors, queries, v, q = tables
    got = inner_product_top_k(v, q, 7, block=block).orderBy("qid", "rank")
    assert [tuple(r) for r in got.select("qid", "rank", "doc_id", "score").collect()] == flat_scan(vectors, queries, 7)


def test_few_vectors_many_queries(tables):
    vectors, queries, v, q = tables
    few = v.filter("doc_id < 20")
    got = inner_product_top_k(few, q, 50, block=30).orderBy("qid", "rank")
    expected = flat_scan(vectors[:20], queries, 50)
    assert len(expected) == 40 * 20
    assert [tuple(r) for r in got.select("qid", "rank", "doc_id", "score").collect()] == expected


def test_empty_sides(tables):
    _, _, v, q = tables
    assert inner_product_top_k(v, q.filter("qid < 0"), 3).count() == 0
    assert inner_product_top_k(v.filter("doc_id < 0"), q, 3).count() == 0


def test_inner_product_is_not_cosine(spark):
    df = spark.sql("select array(1f, 2f) as a, array(3f, 4f) as b")
    assert df.select(inner_product(F.col("a"), F.col("b"))).first()[0] == 11.0


def test_per_query_ranking_limits_before_the_shuffle(tables):
    _, _, v, _ = tables
    rows = v.select((F.col("doc_id") % 3).alias("qid"), "doc_id", F.lit(1.0).alias("score"))
    plan = top_k_per_query(rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_masked_pool(spark):
    rows = spark.createDataFrame(
        [(1, [1.0, 2.0], 1), (1, [3.0, 6.0], 1), (1, [100.0, 100.0], 0), (2, [5.0, 5.0], 0)],
        "k int, v array<float>, m int",
    )
    got = {r["k"]: r["embedding"] for r in masked_mean_pool(rows, "k", "v", "m").collect()}
    assert got == {1: [2.0, 4.0], 2: [0.0, 0.0]}


def test_mean_pool_of_all_masked_is_zero():
    vectors = np.ones((2, 3, 4))
    assert mean_pool(vectors, np.zeros((2, 3))).tolist() == [[0.0] * 4] * 2
    assert mean_pool(vectors, np.array([[1, 1, 0], [1, 0, 0]], float)).tolist() == [[1.0] * 4] * 2


def test_hashed_embedding_by_hand(spark):
    def vector(word):
        digest = hashlib.md5(f"{word}:0".encode()).digest()
        return np.array([(b - 127.5) / 127.5 for b in digest])

    df = spark.createDataFrame([(0, "Cat dog cat"), (1, ""), (2, "dog dog cat cow")], "i int, t string")
    got = df.select("i", embed(F.col("t"), HashedEncoder(16, max_length=2)).alias("e")).orderBy("i").collect()
    # Texts longer than one window are pooled over all their windows.
    assert got[0]["e"] == pytest.approx(((2 * vector("cat") + vector("dog")) / 3).tolist(), abs=1e-6)
    assert got[1]["e"] == [0.0] * 16
    assert got[2]["e"] == pytest.approx(((2 * vector("dog") + vector("cat") + vector("cow")) / 4).tolist(), abs=1e-6)
    with pytest.raises(ValueError):
        HashedEncoder(10)


def test_plugged_in_encoder(spark):
    class LetterEncoder(Encoder):
        """Takes text: one token per letter, padded."""

        step_rows = 2

        def load(self):
            def encode(rows):
                assert len(rows) <= 2
                vectors, mask = np.full((len(rows), 8, 1), 7.0), np.zeros((len(rows), 8))
                for i, text in enumerate(rows):
                    vectors[i, : len(text), 0] = [ord(c) for c in text]
                    mask[i, : len(text)] = 1
                return vectors, mask

            return encode

    df = spark.createDataFrame([("ab",), ("c",), ("abc",), ("z",), ("",)], "t string").coalesce(1)
    got = {r["t"]: r["e"] for r in df.select("t", embed(F.col("t"), LetterEncoder()).alias("e")).collect()}
    assert got == {"ab": [97.5], "c": [99.0], "abc": [98.0], "z": [122.0], "": [0.0]}


def test_many_hits_per_query_are_ranked_in_parts(spark):
    rows = spark.range(0, 20_000).select(F.lit(1).alias("qid"), F.col("id").alias("doc_id"), (F.col("id") % 97).cast("double").alias("score"))
    best = top_k_per_query(rows, 5000)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan and plan.count("Window ") == 2
    expected = sorted(((-(i % 97), i) for i in range(20_000)))[:5000]
    assert [r["doc_id"] for r in best.orderBy("rank").collect()] == [i for _, i in expected]


@pytest.mark.parametrize("query_block, vector_batch", [(7, 50), (40, 13), (1000, 1000)])
def test_blocks_and_batches_equal_flat_scan(tables, query_block, vector_batch):
    """Several query blocks and vector batches meet in cogrouped tasks; nothing passes the driver."""
    vectors, queries, v, q = tables
    got = blocked_top_k(v, q, 7, query_block=query_block, vector_batch=vector_batch).orderBy("qid", "rank")
    assert [tuple(r) for r in got.select("qid", "rank", "doc_id", "score").collect()] == flat_scan(vectors, queries, 7)


def test_blocks_plan_cogroups(tables):
    _, _, v, q = tables
    plan = blocked_top_k(v, q, 3, query_block=10, vector_batch=100)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "BroadcastExchange" not in plan


def test_blocks_with_repeated_query_ids_and_empty_sides(spark, tables):
    vectors, queries, v, q = tables
    twice = q.unionByName(q)
    got = blocked_top_k(v, twice, 4, query_block=9, vector_batch=40).orderBy("qid", "rank")
    assert [tuple(r) for r in got.select("qid", "rank", "doc_id", "score").collect()] == flat_scan(vectors, queries, 4)
    assert blocked_top_k(v, q.filter("qid < 0"), 3).count() == 0
    assert blocked_top_k(v.filter("doc_id < 0"), q, 3).count() == 0


def test_words_are_pooled_as_by_the_encoder(spark):
    """Rows of a table summed by number equal the general way, whatever the length."""
    from marquee.functions import vectors as V

    texts = ["", "one", "deep sea deep", " ".join(f"w{i % 700} Sea" for i in range(1500)), None, "!!!"]
    encoder = V.HashedEncoder(dim=32)
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    embedded = frame.select("i", V.embed(F.col("text"), encoder).alias("v"))
    assert "pandas" not in embedded._jdf.queryExecution().executedPlan().toString().lower()
    got = {r["i"]: np.array(r["v"]) for r in embedded.collect()}
    words = {r["i"]: r["w"] for r in frame.select("i", tokenize(F.col("text")).alias("w")).collect()}
    wanted = V.pooled_windows([words[i] for i in range(len(texts))], encoder, encoder.load())
    assert all(got[i].shape == (32,) and np.allclose(got[i], wanted[i], atol=1e-7) for i in range(len(texts)))
