"""Whitening of embeddings with MLlib's distributed block matrices.

Each finite entry ``c`` becomes the integer ``x = floor(64 c) + OFFSET``; the fit
list holds every distinct x-vector once. Its ``n`` rows are numbered densely
(per-partition counts give offsets, no window over all rows), centred by the
exact per-dimension sums ``S`` and laid out as a ``BlockMatrix``. The scatter
``X'X`` is one transpose-multiply whose middle dimension is split over tasks, so
that no task holds more than ``MID_BLOCKS`` row blocks and partial products are
summed map-side. The ``d x d`` covariance (``d`` the dimension) goes to the
driver, whose symmetric eigen-decomposition gives the components; the whitening
matrix ``U / sqrt(e)`` (``d x k``) is again a ``BlockMatrix`` and one more
multiplication projects every row, copies included. The whitened covariance
over the fit list is computed the same way, as a check.

``deviation`` (the sum over dimensions of ``(n x - S)^2``) is exact: it is
computed with 38-digit decimals in SQL.

Defined cases: rows whose vector is null, holds a null, NaN or infinite entry,
or whose length differs from the largest one are left out; null ids are carried;
repeated vectors are one row of the fit list but every row is returned; an empty
table or one without any sound vector gives no rows; components whose eigenvalue
is not above ``1e-12`` of the trace cannot be whitened and are not returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.sources.storage import scratch_path, write_table

# Fixed values of the task: the integer grid and the number of components.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16

ROWS_PER_BLOCK, COLS_PER_BLOCK = 1024, 256
#: Row blocks of one task of a transpose-multiply.
MID_BLOCKS = 64
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def sound_rows(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``x`` (the integer vector) of every row that is whitened."""
    v = F.col(f"`{column}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = embeddings.where(v.isNotNull() & finite).select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET).alias("x"),
    )
    return rows


def _numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """Adds ``index``: 0 to rows - 1, from per-partition counts and offsets.
    ``df`` must be a written table, whose partitions are the same each time it is read."""
    tagged = df.withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()})
    counts = sorted((r["_part"], r["n"]) for r in tagged.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, total = {}, 0
    for part, n in counts:
        offsets[part] = total
        total += n
    start = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), F.col("_part")) if offsets else F.lit(0)
    within = F.col("_id") - F.shiftleft(F.col("_part").cast("long"), 33)
    return tagged.withColumn("index", start.cast("long") + within).drop("_part", "_id"), total


def _blocks(rows: DataFrame, column: str, n_rows: int, n_cols: int) -> BlockMatrix:
    """``index`` and an array column as a block matrix."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(column).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n_rows, n_cols).toBlockMatrix(ROWS_PER_BLOCK, COLS_PER_BLOCK)


def _product(a: BlockMatrix, b: BlockMatrix) -> BlockMatrix:
    """``a b``, the middle dimension split so that a task multiplies at most ``MID_BLOCKS`` block pairs."""
    splits = max(1, -(-a.numColBlocks // MID_BLOCKS))
    java = a._java_matrix_wrapper._java_model.multiply(b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def _local_blocks(spark, matrix: np.ndarray, rows_per_block: int) -> BlockMatrix:
    """A small local matrix (``d x k``) as a block matrix of row strips."""
    d, k = matrix.shape
    strips = [((i, 0), DenseMatrix(min(rows_per_block, d - i * rows_per_block), k, matrix[i * rows_per_block : (i + 1) * rows_per_block].flatten(order="F").tolist())) for i in range(-(-d // rows_per_block))]
    return BlockMatrix(spark.sparkContext.parallelize(strips, len(strips)), rows_per_block, k, d, k)


def _rows_of(matrix: BlockMatrix) -> DataFrame:
    """``index`` and ``values`` (an array) of each row, without Python."""
    indexed = matrix.toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", indexed._java_matrix_wrapper._java_model)
    return MLUtils.convertVectorColumnsToML(rows, "vector").select("index", vector_to_array("vector").alias("values"))


def whiten(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row per sound input row and component (``RESULT``)."""
    spark = embeddings.sparkSession
    rows = sound_rows(embeddings, column, key)
    d = rows.agg(F.max(F.size("x"))).first()[0]
    if not d:
        return spark.createDataFrame([], RESULT)
    rows = write_table(rows.where(F.size("x") == d), scratch_path(spark, "whitening-rows"))
    fit = write_table(rows.select("x").distinct(), scratch_path(spark, "whitening-fit"))
    sums = (
        fit.select(F.posexplode("x").alias("j", "v"))
        .groupBy("j")
        .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
        .collect()
    )
    n = sums[0]["n"]
    total = [0] * d
    for r in sums:
        total[r["j"]] = int(r["s"])
    mean = F.lit([s / n for s in total])

    def centred(df: DataFrame) -> DataFrame:
        return df.withColumn("xc", F.zip_with("x", mean, lambda v, m: v.cast("double") - m))

    fit_rows, _ = _numbered(fit)
    fit_matrix = _blocks(centred(fit_rows), "xc", n, d)
    scatter = _product(fit_matrix.transpose(), fit_matrix).toLocalMatrix().toArray()
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    trace = float(np.trace(covariance))
    order = [i for i in np.argsort(values)[::-1] if values[i] > 1e-12 * trace][:components]
    if not order:
        return spark.createDataFrame([], RESULT)
    chosen = vectors[:, order]
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(axis=0), range(len(order))])  # one sign for all rows
    e = values[order]
    whitening = _local_blocks(spark, chosen / np.sqrt(e), COLS_PER_BLOCK)

    fit_white = _product(fit_matrix, whitening)
    gram = _product(fit_white.transpose(), fit_white).toLocalMatrix().toArray()
    means = _rows_of(fit_white).select(F.posexplode("values").alias("j", "v")).groupBy("j").agg(F.sum("v").alias("s")).collect()
    m = np.zeros(len(order))
    for r in means:
        m[r["j"]] = r["s"] / n
    identity_error = float(np.abs(gram / n - np.outer(m, m) - np.eye(len(order))).max())

    numbered, count = _numbered(rows)
    projected = _rows_of(_product(_blocks(centred(numbered), "xc", count, d), whitening))
    exact = F.aggregate(
        F.zip_with("x", F.lit(total), lambda v, s: v.cast("decimal(38,0)") * F.lit(n).cast("decimal(38,0)") - s.cast("decimal(38,0)")),
        F.lit(0).cast("decimal(38,0)"),
        lambda acc, t: acc + t * t,
    )
    explained = F.lit([float(v / trace) for v in e])
    return (
        numbered.select("index", "vec_id", exact.cast("long").alias("deviation"))
        .join(projected, "index")
        .select(
            "vec_id", "deviation",
            F.posexplode(F.arrays_zip(F.col("values").alias("w"), explained.alias("r"))).alias("i", "z"),
        )
        .select(
            "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
            F.col("z.w").alias("whitened"), F.col("z.r").alias("explained"), F.lit(identity_error).alias("identity_error"),
        )
    )

