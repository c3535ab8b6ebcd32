"""The job from source to audit row, for every kind of source, and when it fails."""

from __future__ import annotations

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from faresight.operators import audit, quality
from faresight.plans import job
from faresight.schemas import QUALITY_REPORT_SCHEMA
from faresight.session import list_matches, path_exists, read_text
from faresight.sources import bronze, generator, taxi

GREEN = ("lpep_pickup_datetime string, lpep_dropoff_datetime string, passenger_count double, trip_distance double, "
         "PULocationID int, DOLocationID int, fare_amount double, tip_amount double, total_amount double, payment_type double")


def _green_night(spark, passengers=3.0):
    """Three rides around midnight, without a vendor column: the dates differ."""
    return spark.createDataFrame([
        ("2023-06-30 23:40:10", "2023-07-01 00:05:00", passengers, 7.25, 74, 129, 31.0, 0.0, 32.5, 2.0),
        ("2023-07-01 00:10:00", "2023-07-01 00:19:30", passengers, 2.0, 7, 7, 11.4, 3.1, 16.0, 1.0),
        ("2023-07-01 04:59:59", "2023-07-01 05:31:00", None if passengers else passengers, 11.0, 82, 138, 44.0, 0.0, 46.75, 9.0),
    ], GREEN)


def _frame(spark, day, rows, seed):
    return generator.generate_trips(spark, date(2022, 11, day), days=1, rows_per_day=rows, seed=seed)


def _audit_row(spark, root, run_id):
    return audit.latest_runs(audit.read_runs(spark, job.resolve_paths(root).runs_dir)).where(F.col("run_id") == run_id).first()


def test_synthetic_run_leaves_tables_report_summary_and_audit_row(spark, workdir):
    paths = job.resolve_paths(workdir)
    summary = job.run_job(spark, workdir, run_id="autumn.1", source="synthetic", start_date=date(2022, 11, 5),
                          days=3, rows_per_day=31, seed=19)
    assert (summary["status"], summary["error_message"]) == ("succeeded", None)
    assert summary["config"] == {"source": "synthetic", "start_date": "2022-11-05", "days": 3, "rows_per_day": 31, "seed": 19,
                                 "dataset": None, "year": None, "month": None, "source_path": None}
    assert [p.rsplit("/", 2)[1:] for p in summary["ingestion"]["written_paths"]] == [
        [f"pickup_date=2022-11-0{d}", "batch_key=autumn~2E1"] for d in (5, 6, 7)]
    row = _audit_row(spark, workdir, "autumn.1")
    silver, fact = job.read_silver(spark, paths.silver_dir), job.read_fact(spark, paths.fact_dir)
    assert (row.bronze_rows, row.silver_rows, row.gold_rows, row.bronze_files) == (93, silver.count(), fact.count(), 3)
    assert (row.checks_passed, row.checks_failed, row.quality_passed) == (8, 0, True)
    assert fact.agg(F.sum("trip_count")).first()[0] == 93
    assert json.loads(read_text(spark, row.summary_path)) == json.loads(json.dumps(summary, default=str))
    report = spark.read.schema(QUALITY_REPORT_SCHEMA).json(paths.quality_dir)
    assert [r.passed for r in report.orderBy("check_order").collect()] == [True] * 8
    # nothing of the run stays in the session or between the layers
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    assert not list_matches(spark, f"{job.pending_folder(paths)}/*") and not list_matches(spark, f"{workdir}/_staging/*")


def test_green_files_without_vendor(spark, workdir):
    for month, rides in ((6, 1), (7, 2)):
        (_green_night(spark).where(F.month(F.to_timestamp("lpep_pickup_datetime")) == month).coalesce(1)
         .write.parquet(taxi.monthly_path(f"{workdir}/landing", "green", 2023, month)))
    summary = job.run_job(spark, f"{workdir}/wh", run_id="green", source="taxi", dataset="green",
                          source_path=f"{workdir}/landing", max_failures={"invalid_passenger_count": 1})
    assert summary["status"] == "succeeded" and summary["ingestion"]["source_name"] == "taxi_green"
    assert summary["config"]["start_date"] == "2023-06-30" and summary["ingestion"]["partitions"] == 2
    rides = job.read_silver(spark, job.resolve_paths(f"{workdir}/wh").silver_dir).orderBy("pickup_datetime").collect()
    assert [(r.payment_type, r.passenger_count, r.trip_duration_min) for r in rides] == [
        ("cash", 3, 25), ("card", 3, 9), ("unknown", 0, 32)]
    assert all(r.trip_id.startswith("tlc_") for r in rides)


def test_a_copy_that_arrives_out_of_order_loses(spark, workdir):
    """The later-stamped copy wins whichever batch is written first, in a full and in an incremental build."""
    paths = job.resolve_paths(workdir)
    trips = _frame(spark, 2, 13, 23)
    chosen = trips.orderBy(F.desc("trip_id")).first().trip_id
    changed = trips.where(F.col("trip_id") == chosen).withColumn("fare_amount", F.col("fare_amount") + 7)
    bronze.write_bronze(changed, paths.bronze_dir, batch_id="late", ingested_at=datetime(2022, 12, 9, tzinfo=UTC))
    job.run_transforms(spark, paths)
    bronze.write_bronze(trips, paths.bronze_dir, batch_id="early", ingested_at=datetime(2022, 12, 1, tzinfo=UTC))
    for build in (job.run_transforms_incremental, job.run_transforms):
        build(spark, paths)
        silver = job.read_silver(spark, paths.silver_dir)
        hit = audit.trip_lookup(silver, spark.createDataFrame([(chosen,)], "trip_id string")).first()
        assert (hit.copies, hit.max_source_batch_id) == (1, "late") and silver.count() == 13


def test_failed_checks_are_recorded_and_raised(spark, workdir):
    _green_night(spark, passengers=0.0).write.parquet(f"{workdir}/g.parquet")
    with pytest.raises(quality.QualityGateError):
        job.run_job(spark, f"{workdir}/wh", run_id="empty cabs", source="taxi", dataset="green",
                    source_path=f"{workdir}/g.parquet")
    row = _audit_row(spark, f"{workdir}/wh", "empty cabs")
    assert (row.status, row.checks_failed, row.quality_passed) == ("failed", 1, False) and "uality" in row.error_message


def test_errors_before_and_in_a_run(spark, workdir):
    wrong = [dict(source="synthetic"), dict(source="synthetic", start_date=date(2022, 1, 1), rows_per_day=0),
             dict(source="taxi", dataset="red", source_path="x"), dict(source="taxi", year=2022), dict(source="frame"),
             dict(source="kafka"), dict(source="synthetic", start_date=date(2022, 1, 1), silver_mode="some")]
    for settings in wrong:
        with pytest.raises(ValueError):
            job.run_job(spark, workdir, **settings)
    assert audit.read_runs(spark, job.resolve_paths(workdir).runs_dir).count() == 0
    kept = job.run_job(spark, workdir, run_id="lost", source="taxi", source_path=f"{workdir}/no/such", raise_on_failure=False)
    row = _audit_row(spark, workdir, "lost")
    assert kept["status"] == row.status == "failed" and row.error_message and row.bronze_rows is None


def test_a_run_id_used_again_replaces_its_batch_and_its_row(spark, workdir):
    for rows in (41, 29):
        job.run_job(spark, workdir, run_id="again", source="frame", trips=_frame(spark, 8, rows, rows))
    row = _audit_row(spark, workdir, "again")
    assert (row.bronze_rows, row.silver_rows) == (29, 29)
    assert audit.latest_runs(audit.read_runs(spark, job.resolve_paths(workdir).runs_dir)).count() == 1


def test_a_failed_run_is_made_again_under_its_id(spark, workdir, monkeypatch):
    folded, tried = job._fold_and_check, []

    def unsteady(*args):
        tried.append(len(tried))
        if len(tried) < 3:
            raise OSError("a disk is away")
        return folded(*args)
    monkeypatch.setattr(job, "_fold_and_check", unsteady)
    settings = dict(source="frame", trips=_frame(spark, 9, 37, 5), delay=0.0)
    summary = job.run_job_retrying(spark, workdir, run_id="shaky", **settings)
    row = _audit_row(spark, workdir, "shaky")
    assert len(tried) == 3 and summary["status"] == row.status == "succeeded" and (row.bronze_rows, row.silver_rows) == (37, 37)
    assert audit.latest_runs(audit.read_runs(spark, job.resolve_paths(workdir).runs_dir)).count() == 1
    tried.clear()
    with pytest.raises(OSError, match="a disk is away"):
        job.run_job_retrying(spark, workdir, run_id="worse", retries=1, **settings)
    assert len(tried) == 2 and _audit_row(spark, workdir, "worse").status == "failed"
    tried.clear()
    kept = job.run_job_retrying(spark, workdir, run_id="kept", retries=0, raise_on_failure=False, **settings)
    assert (kept["status"], kept["error_message"]) == ("failed", "a disk is away")


def test_what_would_fail_again_is_not_tried_again(spark, workdir, monkeypatch):
    once, tried = job.run_job, []
    monkeypatch.setattr(job, "run_job", lambda *args, **settings: tried.append(1) or once(*args, **settings))
    empty = generator.generate_trips(spark, date(2022, 11, 9), days=1, rows_per_day=20, seed=3).withColumn(
        "passenger_count", F.lit(0).cast("long"))
    with pytest.raises(quality.QualityGateError):
        job.run_job_retrying(spark, workdir, run_id="cabs", source="frame", trips=empty,
                             max_failures={e.name: 0 for e in quality.silver_expectations(None)})
    assert tried == [1] and _audit_row(spark, workdir, "cabs").status == "failed"
    for wrong in (dict(source="kafka"), dict(source="frame")):
        with pytest.raises(ValueError):
            job.run_job_retrying(spark, workdir, **wrong)
    assert tried == [1, 1, 1]
    with pytest.raises(ValueError):
        job.run_job_retrying(spark, workdir, source="frame", trips=empty, retries=-1)
    assert tried == [1, 1, 1]


def test_publishing_waits_for_the_checks(spark, workdir):
    paths = job.resolve_paths(workdir)
    job.run_job(spark, workdir, run_id="fine", source="frame", trips=_frame(spark, 4, 17, 2), publish_only_if_passed=True)
    bad = _frame(spark, 5, 6, 3).withColumn("passenger_count", F.lit(11).cast("long"))
    held = job.run_job(spark, workdir, run_id="poor", source="frame", trips=bad, publish_only_if_passed=True,
                       raise_on_failure=False)
    assert held["status"] == "failed" and job.read_silver(spark, paths.silver_dir).count() == 17
    assert job.read_silver(spark, job.candidate_paths(paths, "poor").silver_dir).count() == 23
    # what was not published is pending: the next run builds from all of bronze
    assert path_exists(spark, job.pending_marker(paths, "poor"))
    last = job.run_job(spark, workdir, run_id="next", source="frame", trips=_frame(spark, 6, 5, 4), raise_on_failure=False)
    assert last["transforms"]["mode"] == "full" and last["transforms"]["silver_rows"] == 28
