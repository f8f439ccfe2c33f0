"""Python functions on executors that may not have this package.

The package's source files are zipped and added to the application once, as one
does with ``spark-submit --py-files``. Functions then travel by name, so that a
worker keeps its caches from task to task of one kind of work. A worker lives on
for later stages: when it goes on to other work it empties them and gives the
memory back, else each executor would hold the largest of all stages for all.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import marquee

_shipped: set[str] = set()
#: Of this worker: what empties its caches, and the kind of work it did last.
_emptying: list[Callable[[], None]] = []
_work: list[str] = []


def ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(marquee.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="marquee-")) / "marquee.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def emptied_between(empty: Callable[[], None]) -> Callable[[], None]:
    """``empty`` is called when a Python worker goes on to other work."""
    _emptying.append(empty)
    return empty


def go_on_to(work: str) -> None:
    """Frees what other work has left in this worker; does nothing for the same work."""
    if _work == [work]:
        return
    _work[:] = [work]
    for empty in _emptying:
        empty()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps its own ways
        pass


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` on executors that know this package."""
    ship(df.sparkSession)
    named = getattr(function, "func", function)  # of a partial
    work = f"{named.__module__}.{named.__qualname__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        go_on_to(work)
        yield from function(batches)

    return df.mapInArrow(run, schema)
