import re

import numpy as np
import pytest
from pyspark.sql import Row

from marquee.operators import dense
from marquee.operators.dense import blocked_top_k


def frame(spark, key, rows, kind="float"):
    return spark.createDataFrame(rows, f"{key} long, embedding array<{kind}>").repartition(3)


def hits(found):
    return [tuple(r) for r in found.select("qid", "rank", "doc_id", "score").orderBy("qid", "rank").collect()]


@pytest.fixture
def every_partition(spark):
    """Shuffled partitions stay as they are, as they do on tables of any size."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_all_blocks_meet_all_batches(spark, every_partition):
    rng = np.random.default_rng(5)
    vectors, queries = rng.integers(-9, 10, (200, 6)).astype(float), rng.integers(-9, 10, (70, 6)).astype(float)
    v = frame(spark, "doc_id", list(enumerate(vectors.tolist())))
    q = frame(spark, "qid", list(enumerate(queries.tolist())), "double")
    expected = []
    for i, query in enumerate(queries):
        scores = vectors @ query
        best = sorted(range(200), key=lambda d: (-scores[d], d))[:4]
        expected += [(i, rank, d, scores[d]) for rank, d in enumerate(best, 1)]
    assert hits(blocked_top_k(v, q, 4, query_block=5, vector_batch=7)) == expected


def test_copies_follow_tiles_and_not_blocks(spark):
    """Vectors in batches of one are not sent once for each query, but once for each tile."""
    rows = [(i, [float(i), 1.0]) for i in range(100)]
    found = blocked_top_k(frame(spark, "doc_id", rows), frame(spark, "qid", rows), 2, query_block=1, vector_batch=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # four tiles of each side for four cores, so four copies of every vector, not a hundred
    assert re.findall(r"shufflepartitionidpassthrough\(.*, (\d+)\)", plan) == ["16", "16"]
    # 615,360 vectors of 64 floats in blocks of 256, on twelve cores
    side = Row("blocks", "rows", "bytes")(2404, 615_360, 615_360 * 256)
    assert dense._tiles(side, side, 3, 12) == (10, 10)


def test_tiles_are_bounded_by_bytes_and_hits():
    side = Row("blocks", "rows", "bytes")
    few, many = side(1, 100, 25_600), side(40_000, 10_000_000, 10_000_000 * 256)
    across, down = dense._tiles(many, many, 3, 8)
    assert many.bytes / across <= dense.TILE_BYTES and many.bytes / down <= dense.TILE_BYTES
    assert many.rows * 1000 / dense._tiles(many, many, 1000, 8)[0] <= dense.TILE_HITS
    assert dense._tiles(few, many, 3, 8)[0] == 1 and dense._tiles(many, few, 3, 8)[1] == 1
    assert dense._tiles(side(0, 0, 0), many, 3, 8)[0] == 1 and dense._tiles(many, side(0, 0, 0), 3, 8)[1] == 1


def test_repeated_documents_and_missing_values(spark, every_partition):
    """A document with several vectors counts once with its best, wherever they lie; a
    vector with a missing value has no product; a missing id is an id like others."""
    rows = [(d, [float(s), 0.0]) for d in range(6) for s in (d, 10 - d)] * 3
    rows += [(7, [99.0, None]), (8, [float("nan"), 99.0]), (None, [9.5, 0.0])]
    asked = [(1, [1.0, 1.0]), (1, [0.0, 1.0]), (None, [1.0, 0.0]), (2, [None, 1.0])]
    best = [(0, 10.0), (None, 9.5), (1, 9.0), (2, 8.0), (3, 7.0)]
    for block in (2, 1000):
        found = blocked_top_k(frame(spark, "doc_id", rows), frame(spark, "qid", asked), 5, query_block=block, vector_batch=block)
        assert hits(found) == [(q, rank, d, s) for q in (None, 1) for rank, (d, s) in enumerate(best, 1)]


def test_unequal_lengths_are_an_error(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0])]
    with pytest.raises(Exception, match="same length|dimensions|mismatch"):
        blocked_top_k(frame(spark, "doc_id", rows), frame(spark, "qid", rows[:1]), 5).collect()


@pytest.mark.parametrize("k", [1, 5, 300])
def test_best_of_many_equal_or_extreme_products(k):
    """Ties by id over several steps, scores that differ after rounding only, and huge ones."""
    rng = np.random.default_rng(k)
    ids = np.arange(0, 6000, 2)
    vectors = rng.integers(-2, 3, (3000, 3)) + rng.choice([0, 2e-7, -3e-7, 1e13], (3000, 3), p=[0.6, 0.19, 0.2, 0.01])
    vectors[:50] = -np.inf
    queries = np.array([[1.0, 1.0, 1.0], [1.0, 0.0, 0.0], [0.5, 0.25, 1e-9], [-1.0, -1.0, -1.0], [0.0, 0.0, 0.0]])
    with np.errstate(invalid="ignore"):
        rows, docs, scores = dense._best_of(queries, ids, vectors, k, 6, False)
        products = np.round(queries @ vectors.T, 6)
    for i in range(len(queries)):
        there = np.flatnonzero(~np.isnan(products[i]))
        top = there[np.lexsort((ids[there], -products[i, there]))][:k]
        assert docs[rows == i].tolist() == ids[top].tolist()
        assert scores[rows == i].tolist() == products[i, top].tolist()


def test_packed_rows_stay_small(spark):
    """Blocks of many long vectors are cut by bytes, so that no row group holds hundreds of megabytes."""
    rows = spark.range(3000, numPartitions=2).selectExpr("id as doc_id", "array_repeat(cast(id as float), 500) as embedding")
    blocks, sizes, kind = dense._packed(rows, "doc_id", 2048, "packed")
    assert (sizes.rows, sizes.bytes, kind) == (3000, 3000 * 2000, "float")
    assert [r["rows"] for r in blocks.orderBy("rows").collect()][-1] == dense.PACKED_BYTES // 2000
