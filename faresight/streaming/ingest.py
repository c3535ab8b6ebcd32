"""Bronze ingestion as a Structured Streaming query.

New files of canonical trips landing in a directory are picked up by a file
source; each micro-batch is written with the same bronze writer as a batch
ingest, under a batch id made of the query's own id, which the checkpoint
keeps, and the micro-batch number. Other queries, and one started on a new
checkpoint, so never write to its partitions. A replayed
micro-batch (restart after a failure) has the same id and rewrites the same
``(date, batch)`` partitions, so delivery into bronze is idempotent. The
checkpoint lives in the shared folder next to the other job state.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from faresight.schemas import TRIP_SCHEMA
from faresight.session import apply_job_conf, read_text
from faresight.sources import bronze


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None
                   ) -> DataFrame:
    """Streaming read of canonical trip parquet files (schema given, no inference)."""
    reader = spark.readStream.schema(TRIP_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_dir)


def batch_id_for(prefix: str, query_id: str, epoch_id: int) -> str:
    return f"{prefix}-{query_id}-{epoch_id:08d}"


def query_id_of(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id of the query that owns a checkpoint, as Spark stored it there."""
    text = read_text(spark, f"{checkpoint_dir.rstrip('/')}/metadata")
    if text is None:
        raise FileNotFoundError(f"no query has started on {checkpoint_dir}")
    return json.loads(text)["id"]


def start_bronze_stream(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                        prefix: str = "stream", available_now: bool = True,
                        max_files_per_trigger: int | None = None,
                        processing_time: str | None = None) -> StreamingQuery:
    """Start the ingestion query; with ``available_now`` it drains what has landed and stops."""
    apply_job_conf(spark)

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        bronze.write_bronze(batch, bronze_dir, batch_id=batch_id_for(prefix, query_id_of(spark, checkpoint_dir), epoch_id),
                            ingested_at=datetime.now(UTC), source_name="stream")

    writer = (landing_stream(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(write_epoch)
              .option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def drain_into_bronze(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                      prefix: str = "stream", max_files_per_trigger: int | None = None) -> None:
    """Ingest everything that has landed so far, then return."""
    query = start_bronze_stream(spark, landing_dir, bronze_dir, checkpoint_dir, prefix,
                                available_now=True, max_files_per_trigger=max_files_per_trigger)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
