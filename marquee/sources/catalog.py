"""The raw catalog: CSV in, Parquet out and in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.postings import doc_bucket
from marquee.sources.storage import write_sorted

# The columns of a catalog file.
CATALOG_COLUMNS = (
    "cast", "cast_id", "cast_url", "certificate", "director", "director_id",
    "director_url", "genre", "gross", "meta_score", "movie_id", "movie_name",
    "movie_url", "plot", "rating", "runtime", "votes", "year",
)

_ROW_BITS = 33
_ODD = "_odd_record"


def read_catalog_csv(
    spark: SparkSession, path: str, multi_line: bool = True
) -> DataFrame:
    """All columns as text, missing values as ``''``, plus ``row_ord``.

    Columns are named by the header, which every file must share; no types are
    inferred. ``row_ord`` grows with file name and place in the file. Records
    with line breaks need ``multi_line``, where one task reads one file; give
    large inputs as many files, or set it off so that files are split.

    A record with more fields than the header ends the read with an error; one
    with fewer lacks the last values.
    """
    form = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    reader = spark.read.options(header=True, multiLine=multi_line, enforceSchema=False, **form)
    columns = reader.csv(path).columns
    missing = sorted(set(CATALOG_COLUMNS) - set(columns))
    if missing:
        raise ValueError(f"columns missing from {path}: {missing}")
    rows = (
        reader.schema(", ".join(f"`{c}` string" for c in (*columns, _ODD)))
        .option("columnNameOfCorruptRecord", _ODD)
        .csv(path)
        .withColumn(columns[0], _checked(columns, form))
        .select(
            *[F.col(f"`{c}`") for c in columns],
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seen"),
        )
        .fillna("", subset=columns)
    )
    return _in_file_order(spark, path, rows) if multi_line else _in_block_order(rows)


def _checked(columns: list[str], form: dict) -> Column:
    """The first column, or an error for a record that has a field too many."""
    wider = ", ".join(f"`{c}` string" for c in (*columns, "_surplus"))
    again = F.from_csv(F.col(_ODD), wider, {**form, "nullValue": "\u0001", "emptyValue": ""})
    fault = F.raise_error(F.concat(F.lit("more fields than the header has: "), F.col(_ODD)))
    return F.when(again["_surplus"].isNotNull(), fault.cast("string")).otherwise(F.col(f"`{columns[0]}`"))


def _in_file_order(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """A file is read by one task, so the row counter grows along it; the rank of
    the file among the listed files goes in front."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"))
    ranked = files.withColumn("_rank", F.row_number().over(Window.orderBy("_file")) - 1)
    place = F.col("_seen").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    order = F.call_function("shiftleft", F.col("_rank").cast("long"), F.lit(_ROW_BITS)) + place
    return rows.join(ranked, "_file").withColumn("row_ord", order).drop("_file", "_block", "_seen", "_rank")


def _in_block_order(rows: DataFrame) -> DataFrame:
    """Rows of a block have consecutive counters; blocks are counted once and
    their starts summed up, one row per block."""
    blocks = rows.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_seen").alias("_first")
    )
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        rows.join(starts, ["_file", "_block"])
        .withColumn("row_ord", F.col("_start") + F.col("_seen") - F.col("_first"))
        .drop("_file", "_block", "_seen", "_first", "_start")
    )


def write_catalog(rows: DataFrame, path: str) -> DataFrame:
    """Replace the catalog table; rows carry their ``doc_id``."""
    keyed = rows.withColumn("doc_bucket", doc_bucket(F.col("doc_id")))
    return write_sorted(keyed, path, ["doc_bucket"], ["doc_id"])


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
