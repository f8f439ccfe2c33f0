"""Where written intermediate tables go, and how sorted tables are laid out."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP_BYTES = 8 << 20
MIN_PARTITION_BYTES = 1 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where driver and tasks
    share one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="marquee-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan for work that is heavy per row: shuffled over all cores if
    the files give fewer partitions than that, and as it is otherwise."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write as Parquet and read back, which also cuts the lineage."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def partition_size(spark: SparkSession, total_bytes: int | None):
    """Aim at smaller rebalanced partitions when ``total_bytes`` would otherwise
    not give every core one; never at larger ones than the session asks for."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if total_bytes is None:
        yield
        return
    before = spark.conf.get(key)
    wanted = max(MIN_PARTITION_BYTES, total_bytes // spark.sparkContext.defaultParallelism)
    if wanted < _bytes(before):
        spark.conf.set(key, wanted)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Bytes of files read at a time where little text makes much work.
HEAVY_SPLIT_BYTES = 16 << 20


@contextmanager
def heavy_splits(spark: SparkSession):
    """Read files in smaller splits than usual, for work that is heavy per row."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if HEAVY_SPLIT_BYTES < _bytes(before):
        spark.conf.set(key, HEAVY_SPLIT_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def joins_where_dealt(spark: SparkSession):
    """Join tables that are dealt alike by some of the join's columns as they lie."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bytes(size: str) -> int:
    """A Spark size such as ``64MB`` or ``67108864b`` as a number."""
    number = size.rstrip("bBkKmMgGtT")
    unit = size[len(number) :].lower()[:1]
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


#: Folders one task writes at the same time; one with more sorts its rows by folder.
OPEN_FOLDERS = 64


@contextmanager
def open_folders(spark: SparkSession):
    """Let a task write into several folders at once, so that its rows need not be
    sorted by folder and stay in the order they have."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, OPEN_FOLDERS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_in_order(df: DataFrame, path: str, folders: list[str]) -> DataFrame:
    """Write into one folder per value of ``folders``, each task its rows in the
    order they have."""
    with open_folders(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .option("compression", "zstd")
            .partitionBy(*folders)
            .parquet(path)
        )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_sorted(
    df: DataFrame, path: str, folders: list[str], order: list[str], total_bytes: int | None = None
) -> DataFrame:
    """Write into one folder per value of ``folders``, sorted inside each file.

    Rebalancing lets adaptive execution merge small folders and split large
    ones over several tasks, so that one hot folder is not one task. Sorted
    files with small row groups let a lookup by ``order`` skip most of a file.
    ``total_bytes`` is an estimate of the shuffled size, if there is one.
    """
    with partition_size(df.sparkSession, total_bytes):
        (
            df.hint("rebalance", *folders)
            .sortWithinPartitions(*folders, *order)
            .write.mode("overwrite")
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .partitionBy(*folders)
            .parquet(path)
        )
    return df.sparkSession.read.schema(df.schema).parquet(path)
