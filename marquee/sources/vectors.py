"""The vector table: (doc_id, embedding) in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_vectors(vectors: DataFrame, path: str) -> None:
    vectors.select("doc_id", "embedding").write.mode("overwrite").parquet(path)


def append_vectors(vectors: DataFrame, path: str) -> None:
    vectors.select("doc_id", "embedding").write.mode("append").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, embedding array<float>").parquet(path)
