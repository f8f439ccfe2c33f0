"""From raw documents to packed sequences, in stages that are written and read again.

``STAGES`` lists (name, function) pairs; each function takes the session, the
documents its predecessor kept and the data folder, and returns a DataFrame.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import kneser_ney, order_minhash, packing, repeated_bytes, rule_ledger
from marquee.sources.storage import scratch_path, write_table

#: Bytes; passages of over fifty words are longer than this.
REPEATED = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rules accepts."""
    return rule_ledger.kept_rows(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is low enough."""
    return kneser_ney.kept_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return order_minhash.kept_rows(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur again."""
    return repeated_bytes.trimmed_rows(docs, REPEATED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]

#: Most stages have no SQL form; a brute-force version checks them in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), scratch_path(spark, f"stage-{name}"))
    return docs
