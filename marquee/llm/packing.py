"""Sum-of-squares packing of documents into sequences of a fixed length.

A document is its token ids and an end id. One longer than a sequence is cut
into full pieces, of which the first may be shorter; all others stay whole. Each
piece goes to the open sequence, or to a new one, that makes the sum of the
squared numbers of open sequences per remaining gap smallest, which keeps the
gaps varied and lets later pieces close them.

Pieces are dealt over shards at random, so that no key decides how many rows a
task gets, and each shard packs its own, longest first. What the shards leave
open is packed again as pieces of its own, in fewer shards. Only lengths move;
ids go along if they are asked for.

Defined cases: a null text counts as empty; an empty text is the end id alone;
repeated rows are separate pieces; null ids are carried through; an empty table
gives an empty result; further columns of the input are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.shipping import map_batches
from marquee.llm.tokens import encoder, groups, tokenizer_path
from marquee.sources.storage import scratch_path, write_table

SEQUENCE = 2048
END_ID = 0
SHARD_PIECES = 32_768
NEVER = np.iinfo(np.int64).max
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """The pieces of all documents, with their ids if asked for."""
    schema = PIECES + (", ids array<long>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaces=True).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in groups(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], encode(texts[a:b])):
                    ids += end
                    n = len(ids) // 4
                    first = n % size or size
                    bounds = [0, *range(first, n + 1, size)]
                    for piece, (x, y) in enumerate(zip(bounds, bounds[1:])):
                        part = ids[4 * x : 4 * y]
                        row = [doc_id, piece, x, y - x, zlib.crc32(part)]
                        rows.append([*row, np.frombuffer(part, "<u4").astype("i8")] if with_ids else row)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_batches, cut, schema)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, and how full each sequence got."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n_open = np.zeros(size + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    fill: list[int] = []
    for i, s in zip(order.tolist(), lengths[order].tolist()):
        # Leaving gap g for g - s changes the sum by 2 * (open(g - s) - open(g)) + 2; a gap of 0 isn't counted.
        gap = size
        if s < size:
            here = n_open[s:size]
            change = 2 * (n_open[: size - s] - here) + 2
            change[0] -= 1
            change[here == 0] = NEVER
            best = int(change.argmin())
            if change[best] <= 2 * n_open[size - s] + 1:
                gap = s + best
        if gap < size:
            b = by_gap[gap].pop()
            n_open[gap] -= 1
        else:
            b = len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += s
        if gap > s:
            by_gap[gap - s].append(b)
            n_open[gap - s] += 1
    return bins, offsets, np.array(fill, np.int64)


def _packed(rows: DataFrame, length: str, size: int, shards: int, names: tuple[str, str, str]) -> DataFrame:
    """Adds the sequence (unique over all shards), the offset there and how full
    that sequence got. A task holds one shard."""
    shard_of = F.spark_partition_id().cast("long")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(map(len, held)):
            return
        table = pa.Table.from_batches(held)
        bins, offsets, fill = sum_of_squares(table[length].to_numpy(), size)
        shard = table["_shard"].to_numpy()
        table = table.drop_columns("_shard")
        for name, values in zip(names, ((shard << 32) + bins, offsets, fill[bins])):
            table = table.append_column(name, pa.array(values, pa.int64()))
        yield from table.to_batches(max_chunksize=10_000)

    schema = T.StructType([*rows.schema.fields])
    for name in names:
        schema = schema.add(name, "long")
    return rows.repartition(shards).withColumn("_shard", shard_of).transform(map_batches, pack, schema)


def assign_sequences(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length``."""
    spark = pieces.sparkSession
    pieces = write_table(pieces, scratch_path(spark, "pieces"))
    shards = -(-pieces.count() // SHARD_PIECES) or 1
    first = write_table(
        _packed(pieces, "length", size, shards, ("_bin", "_place", "_fill")), scratch_path(spark, "packed")
    )
    left = write_table(
        first.where((F.col("_place") == 0) & (F.col("_fill") < size)).select("_bin", "_fill"),
        scratch_path(spark, "open"),
    )
    shards = -(-left.count() // SHARD_PIECES) or 1
    again = _packed(left, "_fill", size, shards, ("_into", "_base", "_full")).select("_bin", "_into", "_base")
    # Closed sequences keep their number; joined ones get negative numbers of their own.
    joined = first.join(again, "_bin", "left")
    return joined.select(
        *pieces.columns,
        F.coalesce(-1 - F.col("_into"), F.col("_bin")).alias("sequence_id"),
        (F.coalesce("_base", F.lit(0).cast("long")) + F.col("_place")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    return assign_sequences(cut_pieces(docs, path, size, end_id, with_ids), size)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, from pieces packed ``with_ids``; a sequence has
    at most its length of ids, so a group is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
