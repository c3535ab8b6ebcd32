"""Helpers the operators share: reading tables, cutting lineage, text bytes.

Lineage is cut by writing a Parquet table below the session's shared folder
(``spark.checkpoint.dir``), never by a local checkpoint, so a lost executor
costs a reread and not a result.
"""

from __future__ import annotations

import ctypes
import gc
import io
import os
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import faresight
from faresight.session import fresh_path

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Text bytes that a Python kernel works on at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a durable stage boundary."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Free what finished stages have left: Spark's cleaner deletes shuffle files once the
    driver's garbage collection finds that nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that none meets a name that an operator gives to a column of its own."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")


def row_key() -> Column:
    """Identity of a documents row: equal for equal (doc_id, text), null doc_id included."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), text_of()))


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    The sources go as a zip through the shared folder and ``addPyFile``, once
    per Spark application.
    """
    sc = spark.sparkContext
    if getattr(sc, "_faresight_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(faresight.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, files in os.walk(top):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = f"{fresh_path(spark, 'code')}/faresight.zip"
    write_bytes(spark, path, packed.getvalue())
    sc.addPyFile(path)
    sc._faresight_shipped = True


def write_bytes(spark: SparkSession, location: str, data: bytes) -> None:
    """One small driver-side file through the location's Hadoop file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def map_arrow(df: DataFrame, kernel, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers first.

    Workers outlive their tasks, so that a task gives back what it has freed:
    else every executor holds the largest need of each stage before.
    """
    ship(df.sparkSession)

    def task(batches):
        try:
            yield from kernel(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Return the memory that this process has freed to the system, where it is glibc's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut into runs of rows with about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = offsets_of(batch.column(column))
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
            stop = min(n, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop


def _plain(column: pa.Array) -> pa.Array:
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.string() if pa.types.is_large_string(column.type) else pa.binary())
    return column


def offsets_of(column: pa.Array) -> np.ndarray:
    """Offsets of a string column into its bytes, one more than it has rows."""
    column = _plain(column)
    if len(column) == 0 or column.buffers()[1] is None:
        return np.zeros(len(column) + 1, np.int64)
    every = np.frombuffer(column.buffers()[1], np.int32)
    return every[column.offset:column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; offsets start at 0."""
    column = _plain(column)
    ends = offsets_of(column)
    buffer = column.buffers()[2] if len(column) else None
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of plain sequences or numpy arrays in the given schema."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema)
