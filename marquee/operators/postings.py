"""Analysed documents, postings and the statistics scoring needs."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import scoring
from marquee.functions.text import tokenize

TEXT_FIELDS = ("name", "cast", "director", "genre", "plot", "certificate")
INT_FIELDS = ("votes", "runtime", "year")
FLOAT_FIELDS = ("rating",)
NUMERIC_FIELDS = INT_FIELDS + FLOAT_FIELDS
BODY = "all_fields"
STORED_FIELDS = (
    "name", "year", "rating", "votes", "runtime", "certificate", "cast",
    "director", "genre", "plot", "movie_id", "movie_url",
)

# One folder of the document table holds 2 to this power of consecutive ids.
DOC_BUCKET_BITS = 18
# Documents are dealt to tasks by 2 to this power of consecutive ids, so that the
# range of an id lies in one task.
SLICE_BITS = 14

# What makes up a document's tokens: the text fields and the year, which only
# counts for ``all_fields``.
_ANALYZED = (*TEXT_FIELDS, "year")
# Tokens put in order at a time (some 200 MB of arrays).
SLICE_TOKENS = 2_000_000


def doc_bucket(doc_id: Column) -> Column:
    return F.call_function("shiftright", doc_id, F.lit(DOC_BUCKET_BITS))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term), F.lit(buckets)).cast("int")


def term_bucket_of(term: str, buckets: int) -> int:
    """``term_bucket`` for a known term, so that a query reads only its folders."""
    return zlib.crc32(term.encode()) % buckets


def id_slice(doc_id: Column) -> Column:
    return F.call_function("shiftright", doc_id.cast("long"), F.lit(SLICE_BITS))


def slice_tasks(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def analyze(cleaned: DataFrame, id_column: str = "row_ord", dealt: bool = False) -> DataFrame:
    """Stored fields plus, per text field, its tokens and token count.

    Texts are tokenised after the rows were dealt to tasks by slices of
    consecutive ids, unless they are ``dealt`` so already, and sorted by id: tokens
    are never shuffled. ``all_fields`` is
    the other fields joined by spaces, so its tokens are theirs put together and
    are not kept.
    """
    lengths = {f"len_{f}": F.size(f"tokens_{f}") for f in TEXT_FIELDS}
    body_length = F.size("tokens_year")
    for f in TEXT_FIELDS:
        body_length = body_length + F.size(f"tokens_{f}")
    lengths[f"len_{BODY}"] = body_length
    rows = (
        cleaned.withColumn("doc_id", F.col(id_column).cast("long"))
        .withColumn("doc_bucket", doc_bucket(F.col("doc_id")))
        .select("doc_bucket", "doc_id", *STORED_FIELDS)
    )
    if not dealt:
        rows = rows.repartition(slice_tasks(cleaned.sparkSession), id_slice(F.col("doc_id")))
    return with_tokens(rows.sortWithinPartitions("doc_bucket", "doc_id")).withColumns(lengths)


def with_tokens(docs: DataFrame) -> DataFrame:
    """Stored fields and, where they lack them, the tokens of the analysed ones."""
    tokens = {f"tokens_{f}": tokenize(F.col(f).cast("string")) for f in _ANALYZED}
    return docs.withColumns({name: words for name, words in tokens.items() if name not in docs.columns})


def _tokens(batch: pa.RecordBatch) -> tuple:
    """All tokens of a batch of analysed documents: the distinct terms, then per
    token its term, field, document and place; then the token counts per field and
    document."""
    n, texts, docs, fields, places, sizes = batch.num_rows, [], [], [], [], []
    for f, name in enumerate(_ANALYZED):
        lists = batch.column(f"tokens_{name}")
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = int(size.sum())
        texts.append(lists.flatten())
        docs.append(np.repeat(np.arange(n), size))
        fields.append(np.full(total, f))
        places.append(np.arange(total) - np.repeat(np.cumsum(size) - size, size))
        sizes.append(size)
    coded = pa.chunked_array(texts).combine_chunks().dictionary_encode()
    terms = coded.indices.to_numpy().astype(np.int64)
    return coded.dictionary, terms, np.concatenate(fields), np.concatenate(docs), np.concatenate(places), np.array(sizes)


def _firsts(key: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start."""
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch in the order of ids, each of about ``SLICE_TOKENS`` tokens
    (one document at least) and inside one slice of ids, so that no two pieces of
    an index cover each other's ids."""
    ids = batch.column("doc_id").to_numpy()
    if (ids[1:] < ids[:-1]).any():
        batch = batch.take(pa.array(np.argsort(ids, kind="stable")))
        ids = batch.column("doc_id").to_numpy()
    counts = np.cumsum(batch.column(f"len_{BODY}").to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(counts, (counts[start - 1] if start else 0) + SLICE_TOKENS, "right"))
        end = min(max(end, start + 1), int(np.searchsorted(ids >> SLICE_BITS, ids[start] >> SLICE_BITS, "right")))
        yield batch.slice(start, end - start)
        start = end


def _analyzed(docs: DataFrame) -> DataFrame:
    return with_tokens(docs).select("doc_id", *[f"tokens_{f}" for f in _ANALYZED], f"len_{BODY}")


# Numbers of blocks are kept in two bytes; a block with a larger one has it in ``wide_``.
# The term comes last: rows of alike blocks then look alike, which shrinks the shuffle.
BLOCKS_SCHEMA = (
    "from_id long, ids array<smallint>, dls array<smallint>, places array<smallint>, tfs array<int>, "
    "starts array<int>, wide_dls array<int>, wide_places array<int>, field string, term string"
)


def _block_rows(field: pa.Array, term: pa.Array, group: np.ndarray, ids: np.ndarray, tf: np.ndarray, dl: np.ndarray, places: np.ndarray | None) -> pa.RecordBatch:
    """Postings, in order, as one row per run of equal ``group``."""
    first = _firsts(group)
    ends = np.r_[first, len(group)]
    sizes = np.diff(ends)

    def lists(values: np.ndarray, at: np.ndarray = ends, null: np.ndarray | None = None, kind: type = np.int32) -> pa.Array:
        mask = None if null is None else pa.array(null)
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(kind)), mask=mask)

    def narrow(values: np.ndarray, at: np.ndarray = ends) -> tuple[pa.Array, pa.Array]:
        large = np.maximum.reduceat(values, at[:-1]) > np.iinfo(np.int16).max
        return lists(values, at, large, np.int16), lists(values, at, ~large)

    single = np.maximum.reduceat(tf, first) == 1
    at, (dls, wide_dls) = pa.array(first), narrow(dl)
    if places is None:
        starts, positions, wide_positions = (pa.nulls(len(first), pa.list_(t)) for t in (pa.int32(), pa.int16(), pa.int32()))
    else:
        before = np.r_[0, np.cumsum(tf)]
        starts = lists(before[:-1] - np.repeat(before[first], sizes), null=single)
        positions, wide_positions = narrow(places, before[ends])
    columns = {
        "from_id": pa.array(ids[first]), "ids": lists(ids - np.repeat(ids[first], sizes), kind=np.int16), "dls": dls,
        "places": positions, "tfs": lists(tf, null=single), "starts": starts, "wide_dls": wide_dls,
        "wide_places": wide_positions, "field": field.take(at), "term": term.take(at),
    }
    return pa.RecordBatch.from_pydict(columns)


def posting_blocks(docs: DataFrame) -> DataFrame:
    """The postings, several to a row, counted inside the documents' own task: per
    field, term and piece of consecutive documents the ids (less the first,
    ``from_id``), frequencies (null if all are one) and field lengths, and for text
    fields the positions one after another with where each document's start.
    ``open_blocks`` takes them apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*TEXT_FIELDS, BODY])
        for piece in (p for batch in batches for p in _slices(batch)):
            terms, term, field, doc, places, sizes = _tokens(piece)
            if not len(term):
                continue
            n, ids = piece.num_rows, piece.column("doc_id").to_numpy()
            key = (term * len(_ANALYZED) + field) * n + doc
            order = np.argsort(key, kind="stable")  # keeps the tokens of a run in the order of the text
            key, places = key[order], places[order]
            starts = _firsts(key)
            tf = np.diff(np.r_[starts, len(key)])
            group, doc = key[starts] // n, key[starts] % n
            term, field = group // len(_ANALYZED), group % len(_ANALYZED)
            text = field < len(TEXT_FIELDS)
            if text.any():
                yield _block_rows(
                    names.take(pa.array(field[text])), terms.take(pa.array(term[text])), group[text], ids[doc[text]], tf[text],
                    sizes[field[text], doc[text]], places[np.repeat(text, tf)],
                )
            pair = term * n + doc
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            starts = _firsts(pair)
            term, doc = pair[starts] // n, pair[starts] % n
            body = names.take(pa.array(np.full(len(starts), len(TEXT_FIELDS))))
            yield _block_rows(
                body, terms.take(pa.array(term)), term, ids[doc], np.add.reduceat(tf[order], starts), sizes.sum(axis=0)[doc], None
            )

    return _analyzed(docs).mapInArrow(run, BLOCKS_SCHEMA)


def open_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks as postings: (field, term, doc_id, tf, dl, positions, from_id) and the
    other columns. The order is kept, and tests of columns a block has are made
    before it is taken apart."""
    packed = ("ids", "tfs", "dls", "wide_dls", "starts", "places", "wide_places")
    others = [c for c in blocks.columns if c not in (*packed, "field", "term", "from_id")]
    at = F.col("_at")
    tf = F.coalesce(F.get("tfs", at), F.lit(1))
    start = F.coalesce(F.get("starts", at), at) + 1
    positions = F.coalesce(F.slice("places", start, tf).cast("array<int>"), F.slice("wide_places", start, tf))
    return blocks.select("*", F.posexplode("ids").alias("_at", "_id")).select(
        "field", "term", (F.col("from_id") + F.col("_id")).alias("doc_id"), tf.alias("tf"),
        F.coalesce(F.get("dls", at).cast("int"), F.get("wide_dls", at)).alias("dl"),
        positions.alias("positions"), "from_id", *others,
    )


def postings(docs: DataFrame) -> DataFrame:
    """(field, term, doc_id, tf, dl, positions) for every searchable text field."""
    return open_blocks(posting_blocks(docs)).drop("from_id")


def block_counts(blocks: DataFrame) -> DataFrame:
    """What ``term_stats`` puts together, from the blocks as they are."""
    return blocks.select(
        "field", "term", F.size("ids").alias("n"), F.coalesce(F.array_max("tfs"), F.lit(1)).alias("max_tf"),
        F.coalesce(F.array_min("dls").cast("int"), F.array_min("wide_dls")).alias("min_dl"),
    )


def term_stats(counts: DataFrame) -> DataFrame:
    """Per field and term: document frequency and the bounds used for pruning, from
    rows that count parts of its documents (blocks or ranges)."""
    return counts.groupBy("field", "term").agg(
        F.sum("n").alias("df"),
        F.max("max_tf").alias("max_tf"),
        F.min("min_dl").alias("min_dl"),
    )


def range_bits_for(n_docs: int) -> int:
    """Bits of a document range: about the square root of the documents in a
    range, between 2^6 and 2^16, so that a range is worth skipping and the table
    of ranges stays far smaller than the postings."""
    return max(6, min(16, math.ceil(math.log2(max(n_docs, 1)) / 2)))


def range_stats(postings: DataFrame, bits: int, average: dict[str, float]) -> DataFrame:
    """Per field, term and range of ``2^bits`` consecutive document ids: the
    documents that have the term, the largest ``tf`` and smallest ``dl`` among
    them, which bound every score the term gives there under any ``k1`` and
    ``b``, and ``max_part``, the largest term part of BM25 with the default
    ones (``average`` is each field's mean length).

    ``postings`` are single ones or blocks. Runs of the written ones, which are
    sorted, are put together where they are read, without a shuffle. A range cut by
    the end of a file or batch has a row from each part, which readers put together.
    """
    names = pa.array([*TEXT_FIELDS, BODY])
    means = np.array([average.get(f, 1.0) for f in names.to_pylist()])
    blocks = "ids" in postings.columns

    def numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Per posting its row, document, ``tf`` and ``dl``."""
        if not blocks:
            return (np.arange(batch.num_rows), *(batch.column(c).to_numpy() for c in ("doc_id", "tf", "dl")))
        lists = batch.column("ids")
        sizes = pc.list_value_length(lists).to_numpy()
        row = np.repeat(np.arange(batch.num_rows), sizes)
        doc = batch.column("from_id").to_numpy()[row] + lists.flatten().to_numpy()
        tf, dl = np.ones(len(row), np.int32), np.empty(len(row), np.int32)
        for values, name in ((tf, "tfs"), (dl, "dls"), (dl, "wide_dls")):
            given = batch.column(name)  # null, and so not in the flat values, for some rows
            values[given.is_valid().to_numpy(zero_copy_only=False)[row]] = given.flatten().to_numpy()
        return row, doc, tf, dl

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            field, term, buckets = batch.column("field"), batch.column("term"), batch.column("term_bucket")
            other = np.ones(batch.num_rows, bool)  # a row of another term than the one before
            other[1:] = False
            for column in (term, field, buckets):
                other[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            row, doc, tf, dl = numbers(batch)
            ranges, run_of = doc >> bits, np.cumsum(other)[row]
            starts = np.flatnonzero(np.r_[True, (ranges[1:] != ranges[:-1]) | (run_of[1:] != run_of[:-1])])
            mean = means[pc.index_in(field, names).to_numpy(zero_copy_only=False)][row]
            part = tf / (tf + scoring.K1 * ((1.0 - scoring.B) + scoring.B * dl / mean))
            at = pa.array(row[starts])
            columns = [
                term.take(at),
                pa.array(ranges[starts]),
                pa.array(np.diff(np.r_[starts, len(tf)])),
                pa.array(np.maximum.reduceat(tf, starts)),
                pa.array(np.minimum.reduceat(dl, starts)),
                pa.array(np.maximum.reduceat(part, starts)),
                field.take(at),
                buckets.take(at),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "doc_range", "n", "max_tf", "min_dl", "max_part", "field", "term_bucket"])

    numeric = ("from_id", "ids", "tfs", "dls", "wide_dls") if blocks else ("doc_id", "tf", "dl")
    return postings.select("field", "term_bucket", "term", *numeric).mapInArrow(
        run, "term string, doc_range long, n long, max_tf int, min_dl int, max_part double, field string, term_bucket int"
    )


#: Terms up to this length are in the deletion table; fuzzy queries whose
#: matches could be longer test the vocabulary instead.
MAX_DELETION_LEN = 20


def deletion_keys(term: Column) -> Column:
    """The term and every string made from it by deleting one or two characters."""
    n = F.length(term)

    def without(i: Column) -> Column:
        return F.concat(F.substring(term, F.lit(1), i - 1), F.substring(term, i + 1, 1 << 20))

    once = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), without)
    twice = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            lambda i: F.transform(
                F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda j: j > i),
                lambda j: F.concat(F.substring(term, F.lit(1), i - 1), F.substring(term, i + 1, j - i - 1), F.substring(term, j + 1, 1 << 20)),
            ),
        )
    )
    return F.array_distinct(F.when(n > 0, F.concat(F.array(term), once, twice)).otherwise(F.array(term)))


def deletions(term_rows: DataFrame) -> DataFrame:
    """(field, key, term): each deletion key of each term up to ``MAX_DELETION_LEN``."""
    short = term_rows.filter(F.length("term") <= MAX_DELETION_LEN)
    return short.select("field", F.explode(deletion_keys(F.col("term"))).alias("key"), "term")


def doc_lengths(docs: DataFrame) -> DataFrame:
    """(field, doc_id, dl); a document without tokens in a field has no row."""
    entries = [
        F.struct(F.lit(f).alias("field"), F.col(f"len_{f}").alias("dl"))
        for f in (*TEXT_FIELDS, BODY)
    ]
    return docs.select("doc_id", F.inline(F.array(*entries))).filter(F.col("dl") > 0)


def field_stats(docs: DataFrame) -> DataFrame:
    """Number of documents and mean length per field."""
    return doc_lengths(docs).groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"),
        (F.sum("dl") / F.count(F.lit(1))).alias("avg_len"),
    )
