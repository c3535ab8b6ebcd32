"""Bronze layer: append-only, date-partitioned parquet with provenance.

Layout: ``{bronze}/pickup_date=<d>/batch_key=<k>/part-*.parquet``; older files
without the batch level may lie beside it (``scan_files``). Writes use dynamic
partition overwrite, so re-running a batch id replaces exactly the
``(date, batch)`` partitions it produces and leaves every other partition,
including other dates of an earlier run of the same batch, in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faresight.functions.columns import batch_key, batch_key_text, iso_utc, parse_timestamp
from faresight.schemas import (BRONZE_PARTITION_COLUMNS, BRONZE_PAYLOAD_SCHEMA, BRONZE_SCHEMA,
                               TRIP_COLUMNS, TRIP_SCHEMA)
from faresight.sources import merges
from faresight.sources.layouts import by_layout, files_of
from faresight.session import apply_job_conf, list_matches, path_exists, stored_files


@dataclass(frozen=True)
class IngestResult:
    source_name: str
    source_reference: str | None
    batch_id: str | None
    batch_key: str | None
    ingested_at: str | None
    rows_read: int
    rows_written: int
    rows_rejected: int
    partitions: int | None
    min_pickup_date: date | None
    bronze_dir: str
    # the batch's (date, batch) partition folders, one per pickup date
    written_paths: list[str] | None = None


def to_iso(value: datetime) -> str:
    """UTC ISO-8601 text with a Z suffix (naive values are taken as UTC)."""
    if value.tzinfo is None:
        value = value.replace(tzinfo=UTC)
    return value.astimezone(UTC).isoformat().replace("+00:00", "Z")


def with_provenance(trips: DataFrame, batch_id: str | None = None,
                    ingested_at: datetime | None = None) -> DataFrame:
    """Canonical trips + ``source_batch_id``, ``ingested_at`` text and the layout columns.

    With ``batch_id`` the rows are stamped as one batch. Without it they must
    already carry ``source_batch_id`` and ``ingested_at`` (a replay of several
    batches in one write); a timestamp ``ingested_at`` is stored as ISO text.
    """
    if batch_id is None:
        present = {f.name: f.dataType for f in trips.schema.fields}
        ingest = F.col("ingested_at")
        if not isinstance(present["ingested_at"], T.StringType):
            ingest = iso_utc(ingest.cast("timestamp_ntz"))
        provenance = [F.col("source_batch_id").cast("string").alias("source_batch_id"),
                      ingest.alias("ingested_at")]
    else:
        if ingested_at is None:
            raise ValueError("ingested_at is required with batch_id")
        provenance = [F.lit(batch_id).alias("source_batch_id"),
                      F.lit(to_iso(ingested_at)).alias("ingested_at")]
    stamped = trips.select(*[F.col(f.name).cast(f.dataType) for f in TRIP_SCHEMA.fields],
                           *provenance)
    return stamped.withColumns({
        "pickup_date": F.to_date("pickup_datetime"),
        "batch_key": batch_key(F.col("source_batch_id")),
    })


def write_bronze(trips: DataFrame, bronze_dir: str, batch_id: str | None = None,
                 ingested_at: datetime | None = None, source_name: str = "unknown",
                 source_reference: str | None = None, rebalance: bool = True) -> IngestResult:
    """Append one batch (or a replay of several) to bronze and describe it.

    Rows without a pickup time have no date partition; they are not written
    and are reported as ``rows_rejected``. Counts come from an observation on
    the write itself (no second pass over the source). With ``rebalance`` the
    rows are redistributed by date before writing (AQE splits a heavy date
    into several files and merges light ones), so a batch yields files of
    roughly the advisory size instead of one small file per task and date.
    """
    spark = trips.sparkSession
    apply_job_conf(spark)
    stamped = with_provenance(trips, batch_id, ingested_at)
    # Observed in the writing stage: Spark merges a result task's metrics once
    # per partition, so a stage re-run after a lost executor does not count twice.
    obs = Observation(f"bronze_{uuid.uuid4().hex[:10]}")
    if rebalance:
        # rows without a date, which are only counted, are spread by trip and not gathered in one task
        deal = F.coalesce(F.col("pickup_date").cast("string"), F.col("trip_id"))
        stamped = stamped.withColumn("_deal", deal).hint("rebalance", "_deal").drop("_deal")
    kept = (stamped.observe(obs,
                            F.count(F.lit(1)).alias("rows_read"),
                            F.count_if(F.col("pickup_date").isNull()).alias("rows_rejected"),
                            F.min("pickup_date").alias("min_pickup_date"))
                   .where(F.col("pickup_date").isNotNull()))
    (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*BRONZE_PARTITION_COLUMNS)
         .parquet(bronze_dir))
    m = obs.get
    key, written = None, None
    if batch_id is not None:
        key = sanitized_key(spark, batch_id)
        written = list_matches(spark, f"{bronze_dir}/pickup_date=*/batch_key={key}")
    return IngestResult(
        source_name=source_name, source_reference=source_reference, batch_id=batch_id,
        batch_key=key, ingested_at=to_iso(ingested_at) if ingested_at else None,
        rows_read=int(m["rows_read"]), rows_written=int(m["rows_read"] - m["rows_rejected"]),
        rows_rejected=int(m["rows_rejected"]),
        partitions=len(written) if written is not None else None,
        min_pickup_date=m["min_pickup_date"], bronze_dir=bronze_dir, written_paths=written,
    )


def sanitized_key(spark: SparkSession, batch_id: str) -> str:
    """Directory-safe key of one batch id (the writer's rule, evaluated on the driver)."""
    return batch_key_text(batch_id)


def batch_partitions(spark: SparkSession, bronze_dir: str, key: str) -> DataFrame:
    """Distinct pickup dates of one batch: its own directories, and row groups of merged files with its key."""
    return scan_bronze(spark, bronze_dir).where(F.col("batch_key") == key).select("pickup_date").distinct()


def scan_bronze(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """All bronze partitions with the directory values as columns.

    The schema is given, so no footer is sampled for inference; filters on
    ``pickup_date`` / ``batch_key`` prune directories, value filters reach
    the parquet reader. Rows of merged files (``sources.merges``) are included.
    """
    rows = spark.read.schema(BRONZE_SCHEMA).option("basePath", bronze_dir).parquet(bronze_dir)
    merged = merges.merged_rows(spark, bronze_dir)
    return rows if merged is None else merges.without_replaced(spark, bronze_dir, rows).unionByName(merged)


# Canonical type of every bronze column, used to widen or narrow old layouts.
_CANONICAL = {f.name: f.dataType for f in BRONZE_SCHEMA.fields}


def canonical_bronze(df: DataFrame) -> DataFrame:
    """Cast any stored bronze layout to the canonical columns.

    Columns missing in the layout (provenance in legacy bronze) become null;
    numeric columns stored with another width or as double are cast;
    nanosecond timestamps read as INT64 are converted.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name, dtype in _CANONICAL.items():
        if name not in present:
            cols.append(F.lit(None).cast(dtype).alias(name))
            continue
        src = present[name]
        if isinstance(dtype, T.TimestampNTZType) and isinstance(src, T.LongType):
            cols.append(F.timestamp_micros(F.floor(F.col(name) / 1000)).cast(dtype).alias(name))
        elif isinstance(dtype, T.StringType) and not isinstance(src, T.StringType) and name == "ingested_at":
            cols.append(iso_utc(F.col(name).cast("timestamp_ntz")).alias(name))
        elif isinstance(dtype, T.LongType) and isinstance(src, (T.DoubleType, T.FloatType)):
            cols.append(F.col(name).try_cast(dtype).alias(name))
        else:
            cols.append(F.col(name).cast(dtype).alias(name))
    return df.select(*cols)


@contextmanager
def _directory_text(spark: SparkSession) -> Iterator[None]:
    """Directory values are read as the text they are (``007`` stays ``007``)."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scan_bronze_layouts(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Merge bronze roots written with different layouts, by column name.

    Each root is read with its own schema (legacy files may lack provenance or
    store ``bigint`` where the current layout has ``double``), cast to the
    canonical types, then combined with ``unionByName``. A single scan with
    ``mergeSchema`` would fail on such type conflicts.
    """
    parts = []
    with _directory_text(spark):
        for root in roots:
            raw = spark.read.option("basePath", root).parquet(root)
            if "batch_key" not in raw.columns:
                raw = raw.withColumn("batch_key", F.lit(None).cast("string"))
            parts.append(canonical_bronze(raw))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


#: Marks a file of the current layout in its path.
BATCH_LEVEL = "/batch_key="


def scan_files(spark: SparkSession, bronze_dir: str, paths: Sequence[str] | None = None,
               layouts: str | None = None) -> DataFrame:
    """Bronze rows of every layout below ``bronze_dir``, or of the files ``paths`` only.

    Files of the current layout are one scan with the given schema. Files
    without the batch level (older writers, pandas) are grouped by the columns
    and types in their footers (kept in the folder ``layouts``, if given, see
    ``sources.layouts``), one scan each; what their folders would say
    follows from the rows: the date from the pickup time, the batch key from
    the batch id. Without ``paths``, files that a merge has replaced are passed
    over for the merged ones (``sources.merges``).
    """
    if paths is None:
        older = stored_files(spark, [bronze_dir]).where(~F.col("path").contains(BATCH_LEVEL))
        current = [f"{bronze_dir}/pickup_date=*{BATCH_LEVEL}*"]
        current = [p for p in current if path_exists(spark, p)]
    else:
        older = files_of(spark, [p for p in paths if BATCH_LEVEL not in p])
        current = [p for p in paths if BATCH_LEVEL in p]
    parts = []
    if current:
        rows = spark.read.schema(BRONZE_SCHEMA).option("basePath", bronze_dir).parquet(*current)
        parts.append(merges.without_replaced(spark, bronze_dir, rows) if paths is None else rows)
    merged = merges.merged_rows(spark, bronze_dir) if paths is None else None
    if merged is not None:
        parts.append(merged)
    for layout in by_layout(spark, older, layouts):
        raw = spark.read.parquet(*layout.paths).drop("pickup_date", "batch_key")
        raw = raw.withColumn("pickup_date", F.to_date(parse_timestamp("pickup_datetime", raw.schema["pickup_datetime"].dataType)))
        if "source_batch_id" not in raw.columns:
            raw = raw.withColumn("source_batch_id", F.lit(None).cast("string"))
        parts.append(canonical_bronze(raw.withColumn("batch_key", batch_key(F.col("source_batch_id")))))
    if not parts:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def legacy_payload(trips: DataFrame) -> DataFrame:
    """Trips in the older bronze layout: no provenance, 32-bit zone ids, double passengers."""
    return trips.select(
        *[F.col(c) for c in TRIP_COLUMNS if c not in ("passenger_count", "pickup_zone_id",
                                                      "dropoff_zone_id")],
        F.col("passenger_count").cast("double").alias("passenger_count"),
        F.col("pickup_zone_id").cast("int").alias("pickup_zone_id"),
        F.col("dropoff_zone_id").cast("int").alias("dropoff_zone_id"),
        F.to_date("pickup_datetime").alias("pickup_date"),
    )


PAYLOAD_COLUMNS = [f.name for f in BRONZE_PAYLOAD_SCHEMA.fields]
