"""Bronze ingestion by Structured Streaming: progress survives restarts, replays are idempotent."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from faresight.schemas import TRIP_COLUMNS
from faresight.session import delete_path
from faresight.sources import bronze, generator
from faresight.streaming import ingest


def _land(spark, landing, day, seed):
    g = generator.generate_trips(spark, date(2025, 1, day), days=1, rows_per_day=40, seed=seed)
    g.select(*TRIP_COLUMNS).coalesce(1).write.mode("append").parquet(landing)


def test_stream_resumes_and_replayed_batch_is_idempotent(spark, workdir):
    landing, out, ckpt = f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ckpt"
    _land(spark, landing, 1, 1)
    _land(spark, landing, 2, 2)
    ingest.drain_into_bronze(spark, landing, out, ckpt, max_files_per_trigger=1)
    batches = lambda: {r.source_batch_id: r["count"]
                       for r in bronze.scan_bronze(spark, out).groupBy("source_batch_id").count().collect()}
    query = ingest.query_id_of(spark, ckpt)
    names = [ingest.batch_id_for("stream", query, n) for n in range(3)]
    assert names[0] == f"stream-{query}-00000000"
    assert batches() == {names[0]: 40, names[1]: 40}
    # a restart picks up only the new file
    _land(spark, landing, 3, 3)
    ingest.drain_into_bronze(spark, landing, out, ckpt, max_files_per_trigger=1)
    assert batches() == dict.fromkeys(names, 40)
    stamp = lambda: {r.ingested_at for r in bronze.scan_bronze(spark, out)
                     .where(F.col("source_batch_id") == names[2]).select("ingested_at").collect()}
    first_stamp = stamp()
    # the last micro-batch is replayed as if the query stopped before committing it
    delete_path(spark, f"{ckpt}/commits/2")
    ingest.drain_into_bronze(spark, landing, out, ckpt, max_files_per_trigger=1)
    assert stamp() != first_stamp          # it was written again ...
    assert batches() == dict.fromkeys(names, 40)
    # ... into the same partitions, so no row is there twice
    assert bronze.scan_bronze(spark, out).select("trip_id").distinct().count() == 120


def test_a_lost_checkpoint_does_not_overwrite_earlier_batches(spark, workdir):
    landing, out = f"{workdir}/landing", f"{workdir}/bronze"
    _land(spark, landing, 1, 1)
    for checkpoint in ("one", "two"):
        ingest.drain_into_bronze(spark, landing, out, f"{workdir}/{checkpoint}")
    found = bronze.scan_bronze(spark, out)
    assert found.count() == 80 and found.select("batch_key").distinct().count() == 2
