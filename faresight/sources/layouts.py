"""Layouts of parquet files: which columns of which types their footers name.

Footers are read by tasks, a batch of files each, and may be kept in a table by
path, length and time of change, so that a file's footer is read once in its
life. The driver gets one row per layout.

Tasks open files with ``pyarrow.fs`` (mounts, HDFS, object stores that it knows).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.session import STORED_FILES_SCHEMA, path_exists

LAYOUTS_SCHEMA = f"{STORED_FILES_SCHEMA}, layout string"
FILE_KEY = ["path", "length", "modified"]
_COLUMNS = "array<struct<name:string,physical:string,logical:string>>"


@dataclass(frozen=True)
class Layout:
    columns: tuple[str, ...]
    paths: list[str]


def files_of(spark: SparkSession, locations: Sequence[str]) -> DataFrame:
    """(path, length, modified) of the files that paths, folders and patterns stand for: one listing of all of
    them, which fails on a path that matches nothing. In folders, files called ``*.parquet`` count."""
    if not locations:
        return spark.createDataFrame([], STORED_FILES_SCHEMA)
    named = [p.rstrip("/").rsplit("/", 1)[-1] for p in locations]
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(locations))
              .select("path", "length", F.unix_micros("modificationTime").alias("modified")))
    return listed.where(F.col("path").endswith(".parquet") | F.substring_index("path", "/", -1).isin(named))


def _footers():
    """Kernel that adds layouts to batches of files. It is made here so that it travels by value:
    executors need not have this package."""
    def read(batches):
        import json
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def opened(path):
            scheme, _, rest = path.rpartition("://") if "://" in path else path.rpartition("file:")
            if scheme in ("", "file"):
                return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
            scheme = "s3" if scheme in ("s3a", "s3n") else scheme
            system, inner = fs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@=+,')}")
            return system.open_input_file(inner)

        def layout(path):
            with opened(path) as file:
                schema = pq.ParquetFile(file).schema
                columns = [schema.column(i) for i in range(len(schema))]
                return json.dumps([{"name": c.path, "physical": c.physical_type, "logical": str(c.logical_type)}
                                   for c in columns])

        for batch in batches:
            found = pa.array([layout(p) for p in batch.column("path").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "layout"])
    return read


def file_layouts(spark: SparkSession, files: DataFrame, kept: str | None = None) -> DataFrame:
    """``files`` (path, length, modified) with the layouts that their footers give, as JSON.

    With ``kept``, a folder, layouts found there are taken from it and the others
    are read and added to it, in a folder of their own each time, so that readers
    at the same time do no harm: a layout found twice is the same layout.
    """
    files = files.select(*FILE_KEY)
    if kept is None:
        return files.mapInArrow(_footers(), LAYOUTS_SCHEMA)
    known = _kept(spark, kept)
    unread = files.join(known, FILE_KEY, "left_anti")
    # coalesced: the anti join leaves few rows of each partition, and the table should have few files
    unread.mapInArrow(_footers(), LAYOUTS_SCHEMA).coalesce(8).write.parquet(f"{kept}/{uuid.uuid4().hex}")
    return files.join(_kept(spark, kept).dropDuplicates(FILE_KEY), FILE_KEY)


def _kept(spark: SparkSession, kept: str) -> DataFrame:
    if not path_exists(spark, kept):
        return spark.createDataFrame([], LAYOUTS_SCHEMA)
    return spark.read.schema(LAYOUTS_SCHEMA).option("recursiveFileLookup", "true").parquet(kept)


def by_layout(spark: SparkSession, files: DataFrame, kept: str | None = None,
              wanted: Sequence[str] | None = None) -> list[Layout]:
    """Files grouped by layout, one driver row per layout with its paths in order; with ``wanted`` only
    these columns tell layouts apart. An empty listing gives no layouts."""
    columns = F.from_json("layout", _COLUMNS)
    if wanted is not None:
        columns = F.filter(columns, lambda c: c["name"].isin(list(wanted)))
    rows = (file_layouts(spark, files, kept).withColumn("columns", F.array_sort(columns))
            .groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect())
    found = [Layout(tuple(c["name"] for c in r["columns"]), r["paths"]) for r in rows]
    return sorted(found, key=lambda x: x.paths[0])
