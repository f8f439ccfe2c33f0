"""Token ids in binary files with Elias-Fano document boundaries.

A folder holds files of consecutive documents in ascending id order and a
manifest table. A file is

    magic ``EFID0001``; documents, documents without an id, token ids, bytes per
    token id (each little-endian 64-bit); the smallest document id (64-bit);
    the token ids; the starts of the documents in Elias-Fano form; the distances
    of their ids from the smallest one in Elias-Fano form.

Document ``i`` is found by two selects. Files are bounded in size, so a reader
holds one at a time.

Rows are range-partitioned by id and a row number, so one id with many rows is
spread as well. Each attempt of a task writes under names of its own and only
the names in the manifest count, so a repeated or lost task does no harm.

Defined cases: a null text counts as empty; an empty text is the end id alone;
null ids come first; rows with equal ids follow each other by the hash of their
texts; an empty table gives no files and an empty result; further columns of the
input are left out.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.elias_fano import EliasFano, encode
from marquee.llm.shipping import map_batches
from marquee.llm.tokens import encoder, groups, tokenizer_path
from marquee.sources.storage import scratch_path, write_table

MAGIC = b"EFID0001"
HEAD = struct.Struct("<QQQQq")
FILE_IDS = 4 << 20
FILE_DOCS = 1 << 16
MANIFEST = "part long, seq long, file string, n_docs long, n_ids long"


def pack_file(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """``ids``: of each document, as little-endian unsigned 32-bit integers."""
    lengths = np.array([len(x) // 4 for x in ids], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    known = [x for x in doc_ids if x is not None]
    base = known[0] if known else 0
    body = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes()
    head = MAGIC + HEAD.pack(len(ids), len(ids) - len(known), int(starts[-1]), width, base)
    # Python numbers: the distance of two 64-bit ids may need 64 bits.
    return head + body + encode(starts) + encode(np.array([x - base for x in known], np.uint64))


class IdFile:
    """A file's documents; ``document(i)`` reads one without unpacking the rest."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token ids")
        self.n_docs, self.n_null, self.n_ids, width, self.base = HEAD.unpack_from(data, len(MAGIC))
        at = len(MAGIC) + HEAD.size
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at)
        self.starts = EliasFano(data, at + self.n_ids * width)
        self.doc_ids = EliasFano(data, self.starts.end)

    def document(self, i: int) -> tuple[int | None, np.ndarray]:
        doc_id = None if i < self.n_null else self.base + self.doc_ids[i - self.n_null]
        return doc_id, self.ids[self.starts[i] : self.starts[i + 1]]

    def all_doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.base + x for x in self.doc_ids.all().tolist()]


def _store(folder: str):
    """The file system of a folder; executors write and read through it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes the files and the manifest; returns the manifest."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    width = 2 if encoder(path, False).tokenizer.get_vocab_size() <= 1 << 16 else 4
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    keys = [F.col("doc_id").asc_nulls_first(), F.col("_tie"), F.col("_row")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(path, spaces=False).encode
        end = np.array([end_id], "<u4").tobytes()
        store, base = _store(folder)
        attempt, seq = uuid.uuid4().hex, 0
        held_docs: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, size, held_docs, held
            name = f"part-{part:06d}-{seq:06d}-{attempt}.ids"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(pack_file(held_docs, held, width))
            values = ((part,), (seq,), (name,), (len(held),), (size,))
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            seq, size, held_docs, held = seq + 1, 0, [], []
            names = ["part", "seq", "file", "n_docs", "n_ids"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            part = batch.column(2)[0].as_py() if len(batch) else 0
            for a, b in groups(texts, 4_000_000):
                for doc_id, ids in zip(doc_ids[a:b], encode_texts(texts[a:b])):
                    held_docs.append(doc_id)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= FILE_IDS or len(held) >= FILE_DOCS:
                        yield flush()
        if held:
            yield flush()

    manifest = ordered.select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))
    return write_table(manifest.transform(map_batches, write, MANIFEST), f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32``, with ``ids`` if asked for."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    n_files = manifest.count()
    # Only the sums of the writing tasks are ordered in one task, one row each.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    based = manifest.withColumn("inside", F.coalesce(inside, F.lit(0))).join(
        parts.select("part", F.coalesce(before, F.lit(0)).alias("before")), "part"
    )
    files = based.select("file", (F.col("before") + F.col("inside")).alias("start")).repartition(max(1, n_files))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{base}/{name}") as source:
                    file = IdFile(source.read())
                bounds = file.starts.all().astype(np.int64)
                doc_ids = file.all_doc_ids()
                for a in range(0, file.n_docs, 4096):
                    b = min(a + 4096, file.n_docs)
                    parts_ = [file.ids[x:y].astype("<u4") for x, y in zip(bounds[a:b].tolist(), bounds[a + 1 : b + 1].tolist())]
                    columns = [
                        pa.array(doc_ids[a:b], pa.int64()),
                        pa.array(bounds[a:b] + start),
                        pa.array(np.diff(bounds[a : b + 1])),
                        pa.array([zlib.crc32(p.tobytes()) for p in parts_], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([p.astype("i8") for p in parts_], pa.list_(pa.int64())))
                    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return files.transform(map_batches, read, schema)


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes all documents to files in the shared folder and reads those back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ids")
    write_ids(docs, folder, tokenizer, end_id)
    return read_ids(spark, folder)
