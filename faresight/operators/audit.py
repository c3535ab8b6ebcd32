"""Batch statistics, per-batch lineage and the run audit table.

Audit rows are appended as parquet; replacing a run's row is expressed as
"newest row per run id" on read (no table format with MERGE is needed).
Columns added to the schema later read as null from older files. Once many
files have come together, ``merge_runs`` folds them into a base sorted by run
id with one row per run, from which a look-up reads the row groups that may
hold its id.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.operators.silver import (RECENCY_ORDER, TIE_BREAK_ORDER, latest_per_key,
                                        typed_trips, validity_condition)
from faresight.schemas import RUN_AUDIT_COLUMNS, RUN_AUDIT_SCHEMA, RUN_LIST_COLUMNS
from faresight.session import create_text, delete_path, list_matches, read_text

#: Appended files that are merged into the base when as many have come together.
MERGE_FILES = 64
#: Runs in a file of the base, and bytes in a row group of it (some thousands of runs).
BASE_FILE_RUNS, BASE_GROUP_BYTES = 1_000_000, 1 << 20


def batch_ingest_stats(bronze: DataFrame) -> DataFrame:
    """Rows, date partitions and earliest pickup date per batch.

    The distinct count of dates inside each batch is planned as a two-level
    aggregation, both levels with partial aggregation, so a batch holding
    most rows is not funnelled through one task.
    """
    return bronze.groupBy("source_batch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("pickup_date").alias("partitions"),
        F.min("pickup_date").alias("min_pickup_date"),
    )


def batch_lineage(bronze: DataFrame) -> DataFrame:
    """Per batch: rows in bronze, rows passing validity, rows surviving in silver,
    rows lost to the filter and rows lost to a newer copy.

    Bronze rows and surviving silver rows are tagged and stacked, then one
    aggregation counts them (no join). The silver side uses the same
    newest-per-trip operator as the silver build, with its pre-shuffle limit.
    """
    typed = typed_trips(bronze)
    flags = typed.select("source_batch_id",
                         F.lit(1).alias("bronze"),
                         F.coalesce(validity_condition(), F.lit(False)).cast("int").alias("valid"),
                         F.lit(0).alias("survivor"))
    winners = latest_per_key(typed.where(validity_condition()), ["trip_id"], RECENCY_ORDER,
                             TIE_BREAK_ORDER)
    survivors = winners.select("source_batch_id", F.lit(0).alias("bronze"), F.lit(0).alias("valid"),
                               F.lit(1).alias("survivor"))
    counts = flags.unionByName(survivors).groupBy("source_batch_id").agg(
        F.sum("bronze").cast("long").alias("bronze_rows"),
        F.sum("valid").cast("long").alias("valid_rows"),
        F.sum("survivor").cast("long").alias("silver_rows"),
    )
    return counts.select(
        "source_batch_id", "bronze_rows", "valid_rows", "silver_rows",
        (F.col("bronze_rows") - F.col("valid_rows")).alias("rejected_rows"),
        (F.col("valid_rows") - F.col("silver_rows")).alias("superseded_rows"),
    )


def layer_counts(layers: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row count per named table, all counted in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
             for name, df in layers]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def distinct_batches(silver: DataFrame) -> DataFrame:
    return silver.agg(F.count_distinct("source_batch_id").alias("distinct_batches"))


def trip_lookup(silver: DataFrame, trip_ids: DataFrame | None = None) -> DataFrame:
    """Copies, newest batch and highest fare per trip id.

    With ``trip_ids`` (one column ``trip_id``) only those ids are looked up,
    through a semi join; without it every trip is described.
    """
    src = silver if trip_ids is None else silver.join(trip_ids.select("trip_id"), "trip_id",
                                                      "left_semi")
    return src.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("source_batch_id").alias("max_source_batch_id"),
        F.max("fare_amount").alias("max_fare_amount"),
    )


# --- run audit table ---------------------------------------------------------------------

def append_run(spark: SparkSession, audit_dir: str, row: dict) -> None:
    """Append one audit row (a later row for the same run id replaces it on read).

    Every append is a folder of its own: runs that end at the same time share no staging folder."""
    values = {name: row.get(name) for name in RUN_AUDIT_COLUMNS}
    target = f"{audit_dir.rstrip('/')}/run-{uuid.uuid4().hex}"
    spark.createDataFrame([values], RUN_AUDIT_SCHEMA).coalesce(1).write.parquet(target)


def _versions(spark: SparkSession, audit_dir: str) -> list[str]:
    """The small files that name the bases made so far, oldest first."""
    return list_matches(spark, f"{audit_dir.rstrip('/')}/_base/[0-9]*.json")


def _described(spark: SparkSession, version: str) -> dict | None:
    """What a version's file says; None while it is being written, or if who made it stopped before."""
    try:
        return json.loads(read_text(spark, version) or "null")
    except json.JSONDecodeError:
        return None


def _current(spark: SparkSession, audit_dir: str) -> dict | None:
    """The last base: its version, its folder, the files merged into it and into the one before it."""
    for version in reversed(_versions(spark, audit_dir)):
        described = _described(spark, version)
        if described:
            return described | {"version": version}
    return None


def _appended(spark: SparkSession, audit_dir: str) -> dict[str, str]:
    """Files of appended rows, each with what is deleted with it: the folder of its append, or, where another
    writer put it into the table's folder itself, the file alone."""
    root = audit_dir.rstrip("/")
    found = {p: p for p in list_matches(spark, f"{root}/*.parquet")}
    found |= {p: p.rsplit("/", 1)[0] for p in list_matches(spark, f"{root}/run-*/*.parquet")}
    return {p: own for p, own in sorted(found.items()) if not p.rsplit("/", 1)[1].startswith(("_", "."))}


def merge_runs(spark: SparkSession, audit_dir: str, least: int = MERGE_FILES) -> bool:
    """Fold the appended rows into a new base if ``least`` files have come together; whether it did.

    The base holds the newest row per run, sorted by run id. It is published by
    a numbered file made exclusively: of two merges at a time one wins and the
    other throws its base away. Readers leave out the files that a base names.
    They and the base before are deleted one merge later, so that who began to
    read before a merge can end; a stop at any place loses and repeats no row.
    """
    root, before = audit_dir.rstrip("/"), _current(spark, audit_dir) or {"version": None, "base": None, "files": [], "older": []}
    stored = _appended(spark, root)
    merged = {*before["files"], *before["older"]}
    fresh = [p for p in stored if p.rsplit("/", 1)[1] not in merged]
    if len(fresh) < least:
        return False
    # what a merge that stopped has left: the new base does not name these any more
    _delete_files(spark, stored, before["older"])
    versions = _versions(spark, root)
    number = int(versions[-1].rsplit("/", 1)[1].removesuffix(".json")) + 1 if versions else 1
    rows = spark.read.schema(RUN_AUDIT_SCHEMA).parquet(*fresh)
    if before["base"]:
        rows = rows.unionByName(_base(spark, root, before["base"]))
    folder = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    files = max(1, math.ceil(rows.count() / BASE_FILE_RUNS))
    (latest_runs(rows).repartitionByRange(files, "run_id").sortWithinPartitions("run_id")
     .write.option("parquet.block.size", BASE_GROUP_BYTES).parquet(f"{root}/_base/{folder}"))
    names = [p.rsplit("/", 1)[1] for p in fresh]
    if not create_text(spark, f"{root}/_base/{number:012d}.json",
                       json.dumps({"base": folder, "files": names, "older": before["files"]})):
        delete_path(spark, f"{root}/_base/{folder}")
        return False
    _delete_files(spark, stored, before["files"])
    _delete_versions(spark, root, [v for v in versions if v != before["version"]])
    return True


def _delete_files(spark: SparkSession, stored: dict[str, str], names: Sequence[str]) -> None:
    for path, own in stored.items():
        if path.rsplit("/", 1)[1] in names:
            delete_path(spark, own)


def _delete_versions(spark: SparkSession, root: str, outdated: list[str]) -> None:
    for version in outdated:
        described = _described(spark, version)
        if described:
            delete_path(spark, f"{root}/_base/{described['base']}")
        delete_path(spark, version)


def _base(spark: SparkSession, root: str, folder: str) -> DataFrame:
    return spark.read.schema(RUN_AUDIT_SCHEMA).parquet(f"{root}/_base/{folder}")


def read_runs(spark: SparkSession, location: str) -> DataFrame:
    """All stored audit rows, from a path or a catalog table / view name.

    An absent table reads as empty with the full schema; columns added to the
    schema later read as null from older data. Rows that ``merge_runs`` found
    replaced by a newer one are no longer stored.
    """
    empty = spark.createDataFrame([], RUN_AUDIT_SCHEMA)
    if "/" not in location and ":" not in location:
        if not spark.catalog.tableExists(location):
            return empty
        stored = spark.table(location)
        return stored.select(*[F.col(f.name).cast(f.dataType) if f.name in stored.columns
                               else F.lit(None).cast(f.dataType).alias(f.name)
                               for f in RUN_AUDIT_SCHEMA.fields])
    current = _current(spark, location)
    try:
        recent = spark.read.schema(RUN_AUDIT_SCHEMA).option("recursiveFileLookup", "true").parquet(location)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in (exc.getCondition() or "") or "Path does not exist" in str(exc):
            return empty
        raise
    if current is None:
        return recent
    merged = [*current["files"], *current["older"]]
    recent = recent.where(~F.col("_metadata.file_name").isin(merged)).select(*RUN_AUDIT_COLUMNS)
    return _base(spark, location.rstrip("/"), current["base"]).unionByName(recent)


def run_of(runs: DataFrame, run_id: str) -> DataFrame:
    """The row of one run. The id reaches the scans, which skip the base's row groups without it."""
    return latest_runs(runs.where(F.col("run_id") == run_id))


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest row per run id (the effect of insert-or-replace on the key)."""
    order = ["started_at", "completed_at", "bronze_rows"]
    present = [c for c in order if c in runs.columns]
    return latest_per_key(runs, ["run_id"], present)


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest runs (a top-k, planned as TakeOrderedAndProject)."""
    cols = [c for c in RUN_LIST_COLUMNS if c in runs.columns]
    return (latest_runs(runs).orderBy(F.col("started_at").desc_nulls_last(),
                                      F.col("bronze_rows").desc_nulls_last(),
                                      F.col("run_id").desc_nulls_last())
            .limit(n).select(*cols))
