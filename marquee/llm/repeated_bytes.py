"""Removal of byte strings that occur again, by a sparse suffix array.

Every byte covered by a string of ``window`` bytes that starts anywhere else goes.

*Anchors.* The place of the smallest hash among the 64-byte strings of a window
depends on the window alone, so equal windows have equal anchors. Consecutive
windows with one anchor are one stretch of text around it; a text has about one
stretch per ``window / 2`` bytes. Only the suffixes at anchors are sorted.

*Counting.* Stretches are combined by content before anything else, so copies in
any number are one row with a count; what has a count of two or more is repeated
as a whole. A stretch whose anchor string occurs nowhere else has no repeated
window. What is left fetches its text.

*Sorting.* The suffixes behind equal anchors, and the reversed texts before
them, are put in order by deep-shallow sorting (``deep_shallow``). Walking the
common prefixes from the longest to the shortest joins groups of stretches; in
each step an element needs to look only at its two neighbours in the order of
the texts before the anchor. That gives for each stretch exactly those windows
that another one has too, in n log^2 n steps and without pairs.

*Hot anchors.* An anchor string in more than ``GROUP`` different stretches (a
common line) is divided by what stands around it: into blocks of ``SPREAD``
neighbouring windows, grouped by all the text these have in common, and if such
a text is that frequent too, into single windows, which are counted.

Defined cases: null text counts as empty; texts under ``window`` bytes lose
nothing on their own; rows with equal ids and texts are each other's copies; an
empty table gives an empty result. Removed bytes may split a character;
``trimmed_rows`` drops the rests of such characters.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.cap_filters import groups_of
from marquee.llm.deep_shallow import common_prefix, sort
from marquee.llm.order_minhash import with_keys
from marquee.llm.shipping import map_batches
from marquee.sources.storage import scratch_path, write_table

WINDOW = 400
ANCHOR = 64
GROUP = 2_048
SPREAD = 48
CHUNK = 2 << 20
PLACE_BITS = 24
KEY = ["h1", "h2"]
ID = ["s1", "s2"]


def byte_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each place on."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    size = 1
    while size < ANCHOR:
        h = h[:-size] * np.uint64(0xD6E8FEB86659FD93) + h[size:]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        size *= 2
    return h ^ (h >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive numbers."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def stretches(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Of texts that fill a chunk: number of the text, anchor, first and last
    window (places in the text), and hash of the anchor string, of each stretch."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array(list(map(len, texts)), np.int64)
    ends = np.cumsum(lengths)
    if len(data) < window:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    hashes = byte_hashes(data)
    ordered = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_min(ordered, window - ANCHOR + 1)
    counts = np.maximum(lengths - window + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    begins = ends - lengths
    first = np.cumsum(counts) - counts
    places = np.arange(len(text)) - np.repeat(first, counts) + np.repeat(begins, counts)
    anchor = (least[places] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    new = np.ones(len(places), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(new)
    last = np.append(start[1:], len(places)) - 1
    base = begins[text[start]]
    return text[start], anchor[start] - base, places[start] - base, places[last] - base, hashes[anchor[start]]


def chunks(texts: list[bytes], window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in chunks of about ``CHUNK`` bytes: row, offset, bytes. A longer text
    is cut so that each of its windows lies in one piece."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(len(text) - window + 1, 1), CHUNK):
            part = text[offset : offset + CHUNK + window - 1]
            rows.append(row)
            offsets.append(offset)
            parts.append(part)
            size += len(part)
            if size >= CHUNK:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
    if parts:
        yield rows, offsets, parts


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """One row per stretch: the text's key, anchor, first and last window, hash
    of the anchor string, and digest of the stretch (``s1``, ``s2``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
            for rows, offsets, parts in chunks(texts, window):
                text, anchor, first, last, gram = stretches(parts, window)
                if not len(text):
                    continue
                digests = np.frombuffer(
                    b"".join(
                        hashlib.blake2b(parts[t][a : b + window], digest_size=16).digest()
                        for t, a, b in zip(text.tolist(), first.tolist(), last.tolist())
                    ),
                    "<i8",
                ).reshape(-1, 2)
                row, offset = np.array(rows)[text], np.array(offsets)[text]
                columns = [h1[row], h2[row], anchor + offset, first + offset, last + offset, gram.view(np.int64), digests[:, 0], digests[:, 1]]
                names = [*KEY, "p", "a", "b", "gram", *ID]
                for x in range(0, len(text), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[x : x + 50_000]), pa.int64()) for c in columns], names=names)

    rows = with_keys(docs.select("text")).select(*KEY, "text").where(F.octet_length("text") >= window)
    return rows.transform(map_batches, run, "h1 long, h2 long, p long, a long, b long, gram long, s1 long, s2 long")


def _texts_of(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Fetches the text of stretches and sets the group in which each is compared.

    ``wanted``: the key of a text, its smallest id, and a list of stretches.
    """
    core = window - SPREAD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spots in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                for x in spots:
                    p, low, high = x["p"], x["p"] - x["b"], x["p"] - x["a"]  # windows begin low to high before the anchor
                    base = (x["s1"], x["s2"], x["alone"])
                    if not x["hot"]:
                        out.append((x["gram"], 0, *base, low, high, high, data[p - high : p - low + window]))
                        continue
                    for block in range(low // SPREAD, high // SPREAD + 1):
                        lo, hi = max(low, block * SPREAD), min(high, block * SPREAD + SPREAD - 1)
                        q = p - block * SPREAD
                        key = hashlib.blake2b(data[q : q + core], digest_size=8, salt=block.to_bytes(4, "little")).digest()
                        out.append((int.from_bytes(key, "little", signed=True), 1, *base, lo, hi, hi, data[p - hi : p - lo + window]))
            for x in range(0, len(out), 10_000):
                columns = zip(*out[x : x + 10_000])
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                names = ["g", "level", *ID, "alone", "low", "high", "q", "body"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    rows = with_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    joined = rows.alias("d").join(
        wanted.alias("w"), (F.col("d.h1") == F.col("w.h1")) & (F.col("d.h2") == F.col("w.h2")) & F.col("d.doc_id").eqNullSafe(F.col("w.first"))
    ).select("text", "spots")
    return joined.transform(
        map_batches, run, "g long, level int, s1 long, s2 long, alone boolean, low int, high int, q int, body binary"
    )


def repeated_windows(bodies: list[bytes], anchors: list[int], window: int) -> list[list[tuple[int, int]]]:
    """For each of some stretches around equal anchors: intervals of how many bytes
    before the anchor a window begins that another stretch has too."""
    right = [x[q:] for x, q in zip(bodies, anchors)]
    left = [x[:q][::-1] for x, q in zip(bodies, anchors)]
    order, prefix = sort(right)
    rank = [0] * len(left)
    for place, i in enumerate(sort(left)[0]):
        rank[i] = place
    by_rank = {rank[i]: i for i in range(len(left))}
    found: list[list[tuple[int, int]]] = [[] for _ in bodies]
    sets = [[rank[i]] for i in range(len(left))]
    parent = list(range(len(left)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    longest = max(map(len, left))
    for k in sorted(range(1, len(order)), key=lambda k: -prefix[k]):
        shared = prefix[k]
        if shared + longest < window:
            break
        x, y = root(order[k - 1]), root(order[k])
        small, large = sorted((x, y), key=lambda r: len(sets[r]))
        for r in sets[small]:
            i = by_rank[r]
            at = bisect_left(sets[large], r)
            for near in sets[large][max(at - 1, 0) : at + 1]:
                j = by_rank[near]
                before = common_prefix(left[i], left[j])
                if before + shared >= window:
                    found[i].append((window - shared, before))
                    found[j].append((window - shared, before))
        parent[small] = large
        sets[large] = sorted(sets[large] + sets[small]) if len(sets[small]) > 8 else _inserted(sets[large], sets[small])
        sets[small] = []
    return found


def _inserted(large: list[int], small: list[int]) -> list[int]:
    for r in small:
        large.insert(bisect_left(large, r), r)
    return large


def _joined(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    result: list[list[int]] = []
    for a, b in sorted(intervals):
        if result and a <= result[-1][1] + 1:
            result[-1][1] = max(result[-1][1], b)
        else:
            result.append([a, b])
    return [(a, b) for a, b in result]


def _compared(rows: DataFrame, window: int) -> DataFrame:
    """Repeated windows of the rows, compared within each group ``g``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["g"]):
            if len(group) < 2:
                continue
            bodies, anchors = group["body"].to_pylist(), group["q"].to_pylist()
            low, high, alone = group["low"].to_pylist(), group["high"].to_pylist(), group["alone"].to_pylist()
            out = []
            for i, intervals in enumerate(repeated_windows(bodies, anchors, window)):
                if alone[i]:
                    out.extend((i, max(a, low[i]), min(b, high[i])) for a, b in _joined(intervals) if max(a, low[i]) <= min(b, high[i]))
            if out:
                i, a, b = (np.array(c) for c in zip(*out))
                ids = [pa.array(group[c].to_numpy()[i]) for c in ID]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=[*ID, "low", "high"])

    return rows.repartition("g").sortWithinPartitions("g").select("g", *ID, "alone", "low", "high", "q", "body").transform(
        map_batches, run, "s1 long, s2 long, low int, high int"
    )


def _counted(rows: DataFrame, window: int) -> DataFrame:
    """Repeated windows of the rows, by counting each single window."""
    at = F.transform(F.sequence("low", "high"), lambda o: F.struct(o.alias("o"), F.substring("body", F.col("q") - o + 1, F.lit(window)).alias("w")))
    single = rows.select(*ID, "alone", F.inline(at)).select(
        *ID, "alone", "o", F.xxhash64("w", F.lit(1)).alias("w1"), F.xxhash64(F.lit(2), "w").alias("w2")
    )
    often = single.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    return single.where("alone").join(often, ["w1", "w2"]).select(*ID, F.col("o").alias("low"), F.col("o").alias("high"))


def spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``h1``, ``h2`` (a text's key) and ``spans``: maximal runs of bytes to remove, as (begin, end), in order."""
    spark = docs.sparkSession
    anchors = write_table(_anchors(docs, window), scratch_path(spark, "anchors"))
    grams = anchors.groupBy("gram").agg(F.count("*").alias("total")).where("total > 1").select("gram")
    # Written before it is grouped: else Spark would group in the tasks of the join, where a hot anchor is one task.
    again = write_table(anchors.join(grams, "gram", "left_semi"), scratch_path(spark, "anchors-again"))
    stretch = write_table(
        again.groupBy("gram", *ID).agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "p", "a", "b")).alias("at")), scratch_path(spark, "stretches")
    )
    groups = (
        stretch.groupBy("gram").agg(F.count("*").alias("c"), F.min("n").alias("least")).where("c > 1 and least = 1")
        .select("gram", (F.col("c") > GROUP).alias("hot"))
    )
    first = with_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).groupBy(*KEY).agg(F.min("doc_id").alias("first"))
    spot = F.struct("gram", *ID, "hot", (F.col("n") == 1).alias("alone"), "at.p", "at.a", "at.b")
    wanted = (
        stretch.join(groups, "gram").select("at.h1", "at.h2", spot.alias("spot"))
        .groupBy(*KEY).agg(F.collect_list("spot").alias("spots")).join(first, KEY)
    )
    texts = write_table(_texts_of(docs, wanted, window), scratch_path(spark, "suffixes"))
    plain = texts.where("level = 0")
    blocks = texts.where("level = 1")
    sizes = blocks.groupBy("g").count().where("count > 1").select("g", (F.col("count") > GROUP).alias("hot"))
    dense = write_table(blocks.join(sizes, "g").where("hot").drop("hot"), scratch_path(spark, "dense"))
    ready = plain.unionByName(blocks.join(sizes, "g").where("not hot").drop("hot"))
    found = write_table(_compared(ready, window).unionByName(_counted(dense, window)), scratch_path(spark, "windows"))
    parts = found.groupBy(*ID).agg(F.collect_list(F.struct("low", "high")).alias("parts"))
    whole = stretch.where("n > 1").select(*ID, F.lit(None).cast(parts.schema["parts"].dataType).alias("parts"))
    covered = again.select(*KEY, "p", "a", "b", *ID).join(whole.unionByName(parts), ID)
    one = F.array(F.struct(F.col("a").alias("x"), (F.col("b") + window).alias("y")))
    some = F.transform("parts", lambda i: F.struct((F.col("p") - i["high"]).alias("x"), (F.col("p") - i["low"] + window).alias("y")))
    pieces = covered.select(*KEY, F.inline(F.when(F.col("parts").isNull(), one).otherwise(some))).distinct()
    return pieces.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("x", "y"))).alias("spans"))


def cut(data: bytes, runs: list[dict]) -> tuple[bytes, int]:
    """What is left of the bytes, and the number of maximal runs removed."""
    kept, end, n = [], 0, 0
    for run in runs:
        if run["x"] > end or not n:
            kept.append(data[end : run["x"]])
            n += 1
        end = max(end, run["y"])
    kept.append(data[end:])
    return b"".join(kept), n


def judged(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of each
    row, and if asked for ``text``: what is left, without the rests of cut characters."""
    fields = [("doc_id", "long"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")]
    fields += [("text", "string")] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                rest, n = cut(data, runs or [])
                row = (len(data), len(data) - len(rest), n, hashlib.sha256(rest).hexdigest())
                out.append((*row, rest.decode("utf-8", "ignore")) if with_text else row)
            columns = list(zip(*out)) or [()] * (len(fields) - 1)
            types = [{"long": pa.int64(), "string": pa.string()}[kind] for _, kind in fields[1:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=[name for name, _ in fields]
            )

    rows = with_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    joined = rows.join(spans(docs, window), KEY, "left").select("doc_id", "text", "spans")
    return joined.transform(map_batches, run, ", ".join(f"{name} {kind}" for name, kind in fields))


def trimmed_rows(docs: DataFrame, window: int = WINDOW, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The input rows, whose ``text`` is what is left and whose ``n_chars`` (if
    there is one) its length. Rows without repeats are as they were."""
    columns = docs.columns
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, runs in enumerate(batch.column(len(columns)).to_pylist()):
                if runs:
                    texts[i] = cut(texts[i].encode("utf-8", "surrogatepass"), runs)[0].decode("utf-8", "ignore")
            arrays = list(batch.columns[: len(columns)])
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    identity = with_keys(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text).alias("text"))).drop("text")
    joined = identity.join(spans(docs, window), KEY, "left")
    result = joined.select("row.*", F.col("spans").alias("_spans")).transform(map_batches, run, docs.schema)
    return result.withColumn(n_chars, F.char_length(text).cast(docs.schema[n_chars].dataType)) if n_chars in columns else result
