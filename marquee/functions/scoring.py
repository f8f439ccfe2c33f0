"""Scoring formulas as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual BM25 parameters.
K1 = 1.2
B = 0.75

# Scores are compared after rounding, so that the order in which Spark adds the
# parts of a sum cannot decide a tie.
SCORE_DECIMALS = 6


def idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - doc_freq + 0.5) / (doc_freq + 0.5))


def saturation(tf: Column, length: Column, avg_length: Column, k1: float = K1, b: float = B) -> Column:
    """The term-frequency part of BM25, between 0 and 1."""
    return tf / (tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * length / avg_length))


def byte4_length(length: Column) -> Column:
    """Length as kept in one byte: exact below 40, four significant bits above."""
    over = length - 24
    shift = F.greatest(F.length(F.bin(over)) - 4, F.lit(0))
    coarse = F.expr("24") + F.call_function(
        "shiftleft", F.call_function("shiftright", over, shift), shift
    )
    return F.when(length < 40, length).otherwise(coarse)


def inner_product(left: Column, right: Column) -> Column:
    """Sum of products over two arrays, in double precision, without normalising."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
