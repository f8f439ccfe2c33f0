"""Exact inner-product search and masked pooling."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from marquee.functions.scoring import SCORE_DECIMALS
from marquee.operators.topk import top_k_per_query
from marquee.sources.storage import ROW_GROUP_BYTES, scratch_path

# A side of at most this many vectors is sent to every task (about 12 MB of
# doubles at 768 dimensions); a larger query side is worked off in such blocks.
BLOCK_VECTORS = 2048

# Rows of the streamed side multiplied at a time.
_CHUNK = 4096

# Of each side, a task of ``blocked_top_k`` holds about this much (65,536 vectors of
# 64 floats), and it gives about this many rows at most.
TILE_BYTES = 16 << 20
TILE_HITS = 1 << 21

# Bytes of a packed block, at most: Parquet looks at its buffers every hundred rows.
PACKED_BYTES = 256 << 10

# Tasks for each core that ``blocked_top_k`` makes if there are enough blocks.
TILES_PER_CORE = 4

# Queries and vectors that are multiplied at a time in such a task.
_ROWS, _COLUMNS = 256, 1024

# Stands for a missing id in packed blocks; missing ids are the first ones.
_NO_ID = np.iinfo(np.int64).min


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


def _products(rows: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Inner products of the streamed rows with a sent block, which may be empty."""
    return rows @ block.T if len(block) else np.empty((len(rows), 0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, highest first, equal scores by id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= kth)
    return places[np.lexsort((ids[places], -scores[places]))][:k]


Block = tuple[np.ndarray, np.ndarray]


def _block(df: DataFrame, key: str, most: int) -> Block | None:
    """Keys and vectors as arrays if there are at most ``most`` rows; None (with
    no more than that read) if there are more."""
    rows = df.select(key, "embedding").limit(most + 1).toPandas()
    if len(rows) > most:
        return None
    return rows[key].to_numpy(), _matrix(rows["embedding"]) if len(rows) else np.empty((0, 0))


class _Best:
    """The k best documents per query seen so far by one task."""

    def __init__(self, queries: int, k: int, decimals: int):
        self.k, self.decimals = k, decimals
        self.floor = np.full(queries, -np.inf)
        self.ids = [np.empty(0, dtype=np.int64)] * queries
        self.scores = [np.empty(0)] * queries

    def add(self, ids: np.ndarray, products: np.ndarray) -> None:
        products = np.round(products, self.decimals)
        better = products >= self.floor
        for q in np.flatnonzero(better.any(axis=0)):
            rows = np.flatnonzero(better[:, q])
            found = np.concatenate([self.ids[q], ids[rows]])
            scores = np.concatenate([self.scores[q], products[rows, q]])
            top = _best(scores, found, self.k)
            self.ids[q], self.scores[q] = found[top], scores[top]
            if len(top) == self.k:
                self.floor[q] = scores[top[-1]]

    def rows(self, qids: np.ndarray) -> pd.DataFrame:
        counts = [len(i) for i in self.ids]
        return pd.DataFrame(
            {
                "qid": np.repeat(qids, counts),
                "doc_id": np.concatenate([*self.ids, np.empty(0, dtype=np.int64)]),
                "score": np.concatenate([*self.scores, np.empty(0)]),
            }
        )


_FOUND = "qid long, doc_id long, score double"


def _chunks(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, len(batch), _CHUNK):
            part = batch.iloc[start : start + _CHUNK]
            yield part[key].to_numpy(), _matrix(part["embedding"])


def _scan_with_queries(vectors: DataFrame, qids, queries, k: int, decimals: int) -> DataFrame:
    """Stream the vectors past the queries; a task gives k rows per query."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Best(len(qids), k, decimals)
        for ids, part in _chunks(batches, "doc_id"):
            best.add(ids, _products(part, queries))
        yield best.rows(qids)

    return vectors.select("doc_id", "embedding").mapInPandas(score, _FOUND)


def _scan_with_vectors(queries: DataFrame, ids, vectors, k: int, decimals: int) -> DataFrame:
    """Stream the queries past all vectors; each query is finished in place."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for qids, part in _chunks(batches, "qid"):
            best = _Best(len(qids), k, decimals)
            best.add(ids, _products(part, vectors).T)
            yield best.rows(qids)

    return queries.select("qid", "embedding").mapInPandas(score, _FOUND)


_KINDS = {"float": np.float32, "double": np.float64}
_PACKED = "turn int, rows int, bytes long, ids binary, vectors binary"


def _arrays(batch: pa.RecordBatch) -> Block:
    ids, vectors = batch.columns
    if vectors.null_count or len(pc.list_value_length(vectors).unique()) > 1:
        raise ValueError("vectors must all have the same length")
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False), values.reshape(len(ids), -1)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a partition, up to ``most`` (and ``PACKED_BYTES``) in a block;
    ``turn`` deals blocks evenly, wherever they lie."""
    turn = TaskContext.get().partitionId()
    kept: Block | None = None

    def packed(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        nonlocal turn
        turn += 1
        row = {"turn": turn, "rows": len(ids), "bytes": vectors.nbytes, "ids": ids.tobytes(), "vectors": vectors.tobytes()}
        return pa.RecordBatch.from_pylist([row], pa.schema([("turn", pa.int32()), ("rows", pa.int32()), ("bytes", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())]))

    for batch in batches:
        if batch.num_rows:
            found = _arrays(batch)
            ids, vectors = found if kept is None else [np.concatenate(x) for x in zip(kept, found)]
            size = max(1, min(most, PACKED_BYTES // max(1, vectors[0].nbytes)))
            whole = len(ids) // size * size
            for start in range(0, whole, size):
                yield packed(ids[start : start + size], vectors[start : start + size])
            kept = ids[whole:], vectors[whole:]
    if kept is not None and len(kept[0]):
        yield packed(*kept)


def _packed(df: DataFrame, key: str, most: int, name: str) -> tuple[DataFrame, Row, str]:
    """The rows as they lie, packed into blocks and written, with their sizes and type."""
    kind = "float" if isinstance(df.schema["embedding"].dataType.elementType, FloatType) else "double"
    rows = df.select(F.col(key).cast("long"), F.col("embedding").cast(f"array<{kind}>"))
    path = scratch_path(df.sparkSession, name)
    packed = rows.mapInArrow(partial(_blocks, most=most), _PACKED)
    packed.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    blocks = df.sparkSession.read.schema(packed.schema).parquet(path)
    sizes = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "bytes")]
    return blocks, blocks.agg(F.count(F.lit(1)).alias("blocks"), *sizes).first(), kind


def _unpacked(blocks: pd.DataFrame, kind: str) -> Block:
    ids = [np.frombuffer(i, np.int64) for i in blocks["ids"]]
    vectors = [np.frombuffer(v, _KINDS[kind]).reshape(len(i), -1) for i, v in zip(ids, blocks["vectors"])]
    return np.concatenate(ids), np.concatenate(vectors).astype(np.float64)


def _ranked(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, repeated: bool) -> np.ndarray:
    """Places of the k best documents of each row (a number from 0), highest first,
    equal scores by id; a document that may be repeated counts once with its best score."""
    order = np.arange(len(rows))
    if repeated:
        order = np.lexsort((-scores, ids, rows))
        again = (np.diff(rows[order]) == 0) & (np.diff(ids[order]) == 0)
        order = np.delete(order, np.flatnonzero(again) + 1)
    order = order[np.lexsort((ids[order], -scores[order], rows[order]))]
    starts = np.flatnonzero(np.diff(rows[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
    return order[rank < k]


def _best_of(
    queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, decimals: int, repeated: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, document, score): the k best of each query among vectors
    that lie by id, so that a later one has to have a higher score. Every product is
    made; only those that can be among the k best are rounded and ranked, when there
    are half as many new ones as are kept."""
    floor = np.full(len(queries), -np.inf)  # the k-th best score so far
    best, waiting, count = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), [], 0

    def before_rounding(score: np.ndarray) -> np.ndarray:
        return score - (10.0**-decimals + 1e-14 * np.abs(score))

    for start in range(0, len(ids), _COLUMNS):
        products = queries @ vectors[start : start + _COLUMNS].T
        least = before_rounding(floor)
        if products.shape[1] >= k and not repeated and np.isneginf(floor).any():
            known = np.where(np.isnan(products), -np.inf, products)
            least = np.fmax(least, before_rounding(np.partition(known, -k, axis=1)[:, -k]))
        some = np.flatnonzero(np.fmax.reduce(products, axis=1) >= least)
        at, column = np.nonzero(products[some] >= least[some, None])
        at = some[at]
        score = np.round(products[at, column], decimals)
        better = (score > floor[at]) | np.isneginf(floor[at])
        waiting.append((at[better], ids[start + column[better]], score[better]))
        count += len(waiting[-1][0])
        if 2 * count > len(best[0]) or start + _COLUMNS >= len(ids):
            row, doc, score = (np.concatenate(x) for x in zip(best, *waiting))
            top = _ranked(row, doc, score, k, repeated)
            best, waiting, count = (row[top], doc[top], score[top]), [], 0
            last = np.flatnonzero(np.diff(best[0], append=-1))
            full = last[np.diff(last, prepend=-1) == k]
            floor[best[0][full]] = best[2][full]
    return best


def _tile_scores(
    key, queries: pd.DataFrame, vectors: pd.DataFrame, k: int, decimals: int, query_kind: str, vector_kind: str
) -> pd.DataFrame:
    """A tile of queries against a tile of vectors: k best per query."""
    if queries.empty or vectors.empty:
        return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "doc_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
    qids, asked = _unpacked(queries, query_kind)
    ids, stored = _unpacked(vectors, vector_kind)
    by_id = np.argsort(ids, kind="stable")
    ids, stored = ids[by_id], stored[by_id]
    repeated = bool((ids[1:] == ids[:-1]).any())
    parts = []
    for start in range(0, len(qids), _ROWS):
        rows, *hits = _best_of(asked[start : start + _ROWS], ids, stored, k, decimals, repeated)
        parts.append((start + rows, *hits))
    rows, found, scores = (np.concatenate(x) for x in zip(*parts))
    _, number = np.unique(qids, return_inverse=True)
    top = _ranked(number[rows], found, scores, k, True)  # rows with one id are one query
    columns = {"qid": qids[rows[top]], "doc_id": found[top]}
    return pd.DataFrame({**{c: pd.arrays.IntegerArray(i, i == _NO_ID) for c, i in columns.items()}, "score": scores[top]})


def _tiles(asked: Row, stored: Row, k: int, cores: int) -> tuple[int, int]:
    """Numbers of tiles of queries and of vectors: as many as their bytes ask for, or
    as give each core some tasks with the fewest copies of vectors."""
    wanted = TILES_PER_CORE * cores
    even = min(wanted, ceil(sqrt(wanted * asked.rows / max(1, stored.rows))))
    hits = asked.rows * min(k, stored.rows)
    across = max(even, ceil(asked.bytes / TILE_BYTES), ceil(hits / TILE_HITS))
    across = max(1, min(across, asked.blocks))
    down = max(ceil(wanted / across), ceil(stored.bytes / TILE_BYTES))
    return across, max(1, min(down, stored.blocks))


def blocked_top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, decimals: int = SCORE_DECIMALS,
    query_block: int = BLOCK_VECTORS, vector_batch: int = BLOCK_VECTORS,
) -> DataFrame:
    """(qid, doc_id, score, rank) for a table of queries of any size against
    vectors of any size, without either side passing the driver.

    Both sides are packed as they lie into blocks of at most ``query_block`` queries
    and batches of at most ``vector_batch`` vectors, a row of up to ``PACKED_BYTES``
    each, and written (so that they are counted and not computed again). Blocks and batches are dealt in turn
    into tiles of up to ``TILE_BYTES``. Every block is sent once to each tile of
    vectors and every batch once to each tile of queries; Spark then cogroups them by
    pair of tiles, a partition for each, so that one task multiplies all blocks of a
    tile with all batches of another and keeps the k best of each query. These lists
    are shuffled once, by query, and merged by ``top_k_per_query``. Every pair is
    scored once; what is shuffled is each query once per tile of vectors (not per
    batch), each vector once per tile of queries, and k hits per query and tile of
    vectors.

    Defined cases: rows with equal ``qid`` are one query whose hits are merged,
    a document counting once with its best score; an empty side gives no rows.
    """
    spark = queries.sparkSession
    query_blocks, asked, query_kind = _packed(queries, "qid", query_block, "query-vectors")
    vector_blocks, stored, vector_kind = _packed(vectors, "doc_id", vector_batch, "vector-batches")
    across, down = _tiles(asked, stored, k, spark.sparkContext.defaultParallelism)

    query_tile, vector_tile = F.col("turn") % across, F.col("turn") % down
    dealt_queries = query_blocks.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    dealt_vectors = vector_blocks.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    dealt_queries = dealt_queries.select((query_tile * down + F.col("to")).alias("tile"), "ids", "vectors")
    dealt_vectors = dealt_vectors.select((F.col("to") * down + vector_tile).alias("tile"), "ids", "vectors")
    score = partial(_tile_scores, k=k, decimals=decimals, query_kind=query_kind, vector_kind=vector_kind)
    found = (
        dealt_queries.repartitionById(across * down, "tile").groupBy("tile")
        .cogroup(dealt_vectors.repartitionById(across * down, "tile").groupBy("tile"))
        .applyInPandas(score, _FOUND)
        .repartition("qid")  # the one shuffle of hits, for what follows too
        .groupBy("qid", "doc_id")  # a document found by rows in several tiles counts once
        .agg(F.max("score").alias("score"))
    )
    return top_k_per_query(found, k, decimals=decimals)


def inner_product_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    decimals: int = SCORE_DECIMALS,
    block: int = BLOCK_VECTORS,
) -> DataFrame:
    """(qid, doc_id, score, rank): the k vectors with the highest inner product
    per query, over vectors (doc_id, embedding) and queries (qid, embedding).

    Every pair is scored, as a flat scan does, but only inside a task by matrix
    product: what leaves a task is at most k rows per query. Either side is sent
    to the tasks only if it fits in one block; when neither does, blocks of
    queries and batches of vectors are cogrouped (``blocked_top_k``).
    """
    sent = _block(queries, "qid", block)
    if sent is not None:
        found = _scan_with_queries(vectors, *sent, k, decimals)
    elif (sent := _block(vectors, "doc_id", block)) is not None:
        found = _scan_with_vectors(queries, *sent, k, decimals)
    else:
        return blocked_top_k(vectors, queries, k, decimals, block, block)
    return top_k_per_query(found, k, decimals=decimals)


def masked_mean_pool(rows: DataFrame, key: str, vector: str, mask: str) -> DataFrame:
    """(key, embedding): mean of the vectors whose mask is 1, zeros if none is.

    Sums are taken per key and dimension before the shuffle, so a key with most
    of the rows sends one row per dimension and task.
    """
    per_dim = (
        rows.select(key, F.col(mask).alias("_m"), F.posexplode(vector).alias("_dim", "_v"))
        .groupBy(key, "_dim")
        .agg(
            F.sum(F.col("_v").cast("double") * F.col("_m")).alias("_sum"),
            F.sum("_m").alias("_count"),
        )
    )
    value = F.col("_sum") / F.greatest(F.col("_count"), F.lit(1e-9))
    ordered = F.sort_array(F.collect_list(F.struct("_dim", value.alias("v"))))
    return per_dim.groupBy(key).agg(ordered["v"].alias("embedding"))
