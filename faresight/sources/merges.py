"""Small bronze files merged into large ones (S4), with batches still replaceable.

``{bronze}.merged/<id>/`` holds one merge:

* ``rows/pickup_date=<d>/bin=<n>/``: bronze rows, a bin being about one target file;
* ``held``: which batches lie in which of these files, (path, length, modified, pickup_date, batch_key, rows);
* ``replaced``: the files whose rows they are, (path, length, modified, pickup_date, batch_key), the last null for a
  merged file;
* ``_done``: written last. From that moment readers take the new files and pass over the replaced ones, which are
  deleted afterwards (``delete_replaced``), so a merge that stops anywhere changes no result.

A batch written again lands in its own folder of bronze as always. A merged row
whose (date, batch) has a live folder is passed over, and the next merge of the
date leaves it out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.schemas import BRONZE_PAYLOAD_SCHEMA, BRONZE_SCHEMA
from faresight.session import (STORED_FILES_SCHEMA, create_text, delete_files, delete_path, list_matches,
                               path_exists, stored_files)

#: Stored bytes of a merged file, and the fewest small files of a date that are worth a merge.
TARGET_BYTES, LEAST_FILES = 128 << 20, 8

HELD_SCHEMA = STORED_FILES_SCHEMA + ", pickup_date date, batch_key string, rows long"
REPLACED_SCHEMA = STORED_FILES_SCHEMA + ", pickup_date date, batch_key string"
FILE = ["path", "length", "modified"]
BATCH = ["pickup_date", "batch_key"]

_NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def merged_dir(bronze_dir: str) -> str:
    return f"{bronze_dir.rstrip('/')}.merged"


def _folders(spark: SparkSession, bronze_dir: str) -> list[str]:
    """Folders of the finished merges."""
    return [p.removesuffix("/_done") for p in list_matches(spark, f"{merged_dir(bronze_dir)}/*/_done")]


def _table(spark: SparkSession, folders: list[str], name: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema).parquet(*[f"{f}/{name}" for f in folders]) if folders
            else spark.createDataFrame([], schema))


def _held(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Batches of the merged files that no later merge has replaced."""
    gone = _table(spark, folders, "replaced", REPLACED_SCHEMA).where("batch_key IS NULL")
    return _table(spark, folders, "held", HELD_SCHEMA).join(gone, FILE, "left_anti")


def live_files(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """(path, length, modified) of the files whose rows are bronze now, merged ones included."""
    listed, folders = stored_files(spark, [bronze_dir]), _folders(spark, bronze_dir)
    if not folders:
        return listed
    old = _table(spark, folders, "replaced", REPLACED_SCHEMA)
    return listed.join(old, FILE, "left_anti").unionByName(_held(spark, folders).select(*FILE).distinct())


def _path_value(name: str) -> Column:
    return F.regexp_extract("path", f"/{name}=([^/]+)/", 1)


def batch_files(listed: DataFrame) -> DataFrame:
    """The files of ``listed`` that lie in batch folders, with (pickup_date, batch_key); those without a batch id,
    whose folder has no name of its own, are not among them."""
    key = _path_value("batch_key")
    return (listed.where(key != "").where(key != _NO_KEY)
            .withColumns({"pickup_date": F.to_date(_path_value("pickup_date")), "batch_key": key}))


def overridden(spark: SparkSession, bronze_dir: str, listed: DataFrame) -> DataFrame | None:
    """The merged (pickup_date, batch_key) that a folder of ``listed`` has written again; None without merges."""
    folders = _folders(spark, bronze_dir)
    if not folders:
        return None
    return _held(spark, folders).select(*BATCH).distinct().join(batch_files(listed), BATCH, "left_semi")


def written_again(spark: SparkSession, bronze_dir: str, files: DataFrame) -> bool:
    """Whether one of the ``files`` lies in the folder of a batch that a merge has taken in."""
    folders = _folders(spark, bronze_dir)
    if not folders:
        return False
    merged = _held(spark, folders).select(*BATCH).unionByName(_table(spark, folders, "replaced", REPLACED_SCHEMA).select(*BATCH))
    return not batch_files(files).join(merged, BATCH, "left_semi").isEmpty()


def _place_of_path() -> Column:
    """Merge, date, bin and name of a merged file, from its path; ``_place_of_row`` has the same of a row."""
    return F.concat_ws("/", F.regexp_extract("path", "/([^/]+)/rows/pickup_date=", 1), _path_value("pickup_date"),
                       _path_value("bin"), F.element_at(F.split("path", "/"), -1))


def _place_of_row(folder: str) -> Column:
    return F.concat_ws("/", F.lit(folder.rsplit("/", 1)[1]), F.col("pickup_date").cast("string"),
                       F.col("bin").cast("string"), F.col("_metadata.file_name"))


def _stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    where = f"{folder}/rows"
    return (spark.read.schema(BRONZE_SCHEMA).option("basePath", where).parquet(f"{where}/pickup_date=*")
                 .withColumn("_place", _place_of_row(folder)))


def merged_rows(spark: SparkSession, bronze_dir: str) -> DataFrame | None:
    """Bronze rows of the merged files, as ``BRONZE_SCHEMA``; None if there are none."""
    folders = _folders(spark, bronze_dir)
    full = [f for f in folders if path_exists(spark, f"{f}/rows/pickup_date=*")]
    if not full:
        return None
    rows = _stored_rows(spark, full[0])
    for folder in full[1:]:
        rows = rows.unionByName(_stored_rows(spark, folder))
    gone = _table(spark, folders, "replaced", REPLACED_SCHEMA).where("batch_key IS NULL")
    left = stored_files(spark, [f"{f}/rows" for f in full]).join(gone, FILE, "left_semi")
    if not left.isEmpty():
        rows = rows.join(left.select(_place_of_path().alias("_place")), "_place", "left_anti")
    again = overridden(spark, bronze_dir, live_files(spark, bronze_dir))
    if not again.isEmpty():
        rows = rows.join(again, BATCH, "left_anti")
    return rows.select(*[f.name for f in BRONZE_SCHEMA.fields])


def without_replaced(spark: SparkSession, bronze_dir: str, rows: DataFrame) -> DataFrame:
    """``rows`` of bronze's batch folders without those of replaced files that are not deleted yet."""
    folders = _folders(spark, bronze_dir)
    if not folders:
        return rows
    old = _table(spark, folders, "replaced", REPLACED_SCHEMA).where("batch_key IS NOT NULL")
    left = stored_files(spark, [bronze_dir]).join(old, FILE, "inner")
    if left.isEmpty():
        return rows
    left = left.select(*BATCH, F.element_at(F.split("path", "/"), -1).alias("_file"))
    named = rows.withColumn("_file", F.col("_metadata.file_name"))
    return named.join(left, [*BATCH, "_file"], "left_anti").drop("_file")


@dataclass(frozen=True)
class Merge:
    id: str
    dates: int
    files_before: int
    files_after: int
    rows: int


def merge_files(spark: SparkSession, bronze_dir: str, settled: DataFrame, target_bytes: int = TARGET_BYTES,
                least_files: int = LEAST_FILES, ready: Callable[[], None] = lambda: None) -> Merge | None:
    """Merge the small batch folders and merged files of every date that has ``least_files`` of their files.

    Only dates all of whose files are ``settled(path, length, modified)`` are
    taken. A folder goes in whole, or not at all if it holds ``target_bytes``;
    so does a merged file that holds a batch written again. A date's batches
    are packed, in the order of their keys, into bins that start within the
    same ``target_bytes``; a batch lies in one bin, a bin is one task. Files
    of older layouts stay as they are. ``ready`` is called before the merge
    counts, and may raise. None if no date has enough files.
    """
    # the listing is written: what is merged and what is named as replaced have to be the same files
    stage = f"{merged_dir(bronze_dir)}/{uuid.uuid4().hex[:12]}"
    live_files(spark, bronze_dir).write.parquet(f"{stage}/listed")
    listed = spark.read.schema(STORED_FILES_SCHEMA).parquet(f"{stage}/listed")
    day = F.to_date(F.nullif(_path_value("pickup_date"), F.lit("")))
    unsettled = listed.join(settled, FILE, "left_anti").select(day.alias("pickup_date")).distinct()

    own = batch_files(listed)
    small = own.groupBy(*BATCH).agg(F.sum("length").alias("bytes")).where(F.col("bytes") < target_bytes)
    own = own.join(small.select(*BATCH), BATCH, "left_semi")
    folders = _folders(spark, bronze_dir)
    held = _held(spark, folders)
    again = held.join(batch_files(listed), BATCH, "left_semi").select(*FILE).distinct().withColumn("again", F.lit(True))
    old = (held.select(*FILE, "pickup_date").distinct().join(again, FILE, "left")
           .where((F.col("length") < target_bytes / 2) | F.col("again")).drop("again"))
    taken = own.select(*FILE, *BATCH).unionByName(old.withColumn("batch_key", F.lit(None).cast("string")))
    enough = (taken.groupBy("pickup_date").agg(F.count("*").alias("files")).where(F.col("files") >= max(2, least_files))
              .join(unsettled, "pickup_date", "left_anti").select("pickup_date"))
    taken.join(enough, "pickup_date", "left_semi").select(*FILE, *BATCH).write.parquet(f"{stage}/replaced")
    replaced = spark.read.schema(REPLACED_SCHEMA).parquet(f"{stage}/replaced")
    before = replaced.agg(F.count("*"), F.count_distinct("pickup_date")).first()
    if not before[0]:
        delete_path(spark, stage)
        return None

    # where each batch of the taken files lies, and its part of their bytes
    in_folders = replaced.where("batch_key IS NOT NULL").groupBy(*BATCH).agg(F.sum("length").cast("double").alias("bytes"))
    share = held.join(replaced.where("batch_key IS NULL").select(*FILE), FILE, "left_semi")
    per_file = share.groupBy(*FILE).agg(F.sum("rows").alias("all"))
    in_merged = (share.join(per_file, FILE).join(batch_files(listed), BATCH, "left_anti")
                 .groupBy(*BATCH).agg(F.sum(F.col("length") * F.col("rows") / F.col("all")).alias("bytes")))
    _packed(in_folders.unionByName(in_merged), target_bytes).write.parquet(f"{stage}/bins")
    bins = spark.read.schema("pickup_date date, batch_key string, bin long").parquet(f"{stage}/bins")

    tasks = bins.select("pickup_date", "bin").distinct().count()
    (_rows_of(spark, bronze_dir, replaced, bins).repartition(max(1, tasks), "pickup_date", "bin")
     .sortWithinPartitions("pickup_date", "bin", "batch_key")
     .write.partitionBy("pickup_date", "bin").parquet(f"{stage}/rows"))
    new = stored_files(spark, [f"{stage}/rows"]).withColumn("_place", _place_of_path())
    if new.isEmpty():
        spark.createDataFrame([], HELD_SCHEMA).write.parquet(f"{stage}/held")
    else:
        (_stored_rows(spark, stage).groupBy(*BATCH, "_place").agg(F.count("*").alias("rows")).join(new, "_place")
         .select(*FILE, *BATCH, "rows").write.parquet(f"{stage}/held"))
    after = spark.read.schema(HELD_SCHEMA).parquet(f"{stage}/held").agg(F.count_distinct("path"), F.sum("rows")).first()
    ready()
    if not create_text(spark, f"{stage}/_done", ""):
        raise FileExistsError(stage)
    return Merge(stage.rsplit("/", 1)[1], int(before[1]), int(before[0]), int(after[0] or 0), int(after[1] or 0))


def _packed(batches: DataFrame, target_bytes: int) -> DataFrame:
    """(pickup_date, batch_key, bin): batches of a date in bins that start in the same ``target_bytes``."""
    line = Window.partitionBy("pickup_date").orderBy("batch_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(line), F.lit(0.0))
    return batches.select(*BATCH, F.floor(start / target_bytes).alias("bin"))


def _rows_of(spark: SparkSession, bronze_dir: str, replaced: DataFrame, bins: DataFrame) -> DataFrame:
    """Rows of the files that a merge takes, with their ``bin``: dates are pruned, files chosen by name."""
    own = replaced.where("batch_key IS NOT NULL")
    columns = [f.name for f in BRONZE_PAYLOAD_SCHEMA.fields] + BATCH
    dates = [r.pickup_date for r in replaced.select("pickup_date").distinct().collect()]   # one value a calendar day
    folders = f"{bronze_dir}/pickup_date={{{','.join(map(str, dates))}}}/batch_key=*"
    parts = []
    if path_exists(spark, folders):
        files = own.select(*BATCH, F.element_at(F.split("path", "/"), -1).alias("_file"))
        parts.append(spark.read.schema(BRONZE_SCHEMA).option("basePath", bronze_dir).parquet(folders)
                     .withColumn("_file", F.col("_metadata.file_name")).join(files, [*BATCH, "_file"], "left_semi"))
    older = merged_rows(spark, bronze_dir)
    if older is not None:
        parts.append(older.where(F.col("pickup_date").isin(dates)))
    rows = parts[0].select(*columns)
    for part in parts[1:]:
        rows = rows.unionByName(part.select(*columns))
    # batches of merged files that stay as they are have no bin
    return rows.join(bins, BATCH)


def settled_after(spark: SparkSession, bronze_dir: str, settled: DataFrame) -> DataFrame:
    """``settled`` with the files of a merge in the place of those it replaced."""
    folders = _folders(spark, bronze_dir)
    if not folders:
        return settled
    old = _table(spark, folders, "replaced", REPLACED_SCHEMA)
    part = settled.join(old, FILE, "left_semi")
    if part.isEmpty():
        return settled
    # every merge took settled files only, so all that the merges hold now is settled
    return (settled.join(old, FILE, "left_anti").select(*FILE)
            .unionByName(_held(spark, folders).select(*FILE)).distinct())


def delete_replaced(spark: SparkSession, bronze_dir: str) -> int:
    """Delete replaced files, the folders they leave empty and merges of which nothing is left; returns the files.

    Files are deleted by name: a batch that is being written again keeps its new ones.
    """
    folders = _folders(spark, bronze_dir)
    old = _table(spark, folders, "replaced", REPLACED_SCHEMA)
    there = stored_files(spark, [bronze_dir, *[f"{f}/rows" for f in folders]]).join(old.select(*FILE), FILE, "left_semi")
    deleted = delete_files(spark, (r.path for r in there.select("path").toLocalIterator()))
    live = {r.id for r in _held(spark, folders).select(F.regexp_extract("path", "/([^/]+)/rows/", 1).alias("id"))
            .distinct().collect()}   # one value a merge
    for folder in folders:
        if folder.rsplit("/", 1)[1] not in live:
            delete_path(spark, folder)
    return deleted
