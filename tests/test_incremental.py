"""Incremental silver/fact maintenance equals the full refresh."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from faresight.operators import audit, quality
from faresight.plans import job
from faresight.schemas import SILVER_COLUMNS
from faresight.sources import bronze, generator


def _rows(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, pickup_datetime timestamp_ntz, "
                                       "dropoff_datetime timestamp_ntz, passenger_count long, "
                                       "trip_distance double, pickup_zone_id long, dropoff_zone_id long, "
                                       "fare_amount double, tip_amount double, total_amount double, "
                                       "payment_type string")


def _t(s):
    return datetime.fromisoformat(s)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_moved_winner_empties_its_old_date(spark, workdir):
    paths = job.resolve_paths(workdir)
    first = _rows(spark, [
        ("t1", _t("2025-01-01 08:00:00"), _t("2025-01-01 08:10:00"), 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card"),
        ("t2", _t("2025-01-03 08:00:00"), _t("2025-01-03 08:10:00"), 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card"),
        (None, _t("2025-01-03 09:00:00"), _t("2025-01-03 09:10:00"), 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card"),
    ])
    bronze.write_bronze(first, paths.bronze_dir, batch_id="b1", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    job.run_transforms(spark, paths)
    # newer copy of t1 with another pickup day, and a newer null-id trip
    later = _rows(spark, [
        ("t1", _t("2025-01-02 07:00:00"), _t("2025-01-02 07:20:00"), 2, 2.0, 3, 4, 9.0, 0.0, 9.5, "cash"),
        (None, _t("2025-01-03 10:00:00"), _t("2025-01-03 10:10:00"), 1, 1.0, 1, 2, 6.0, 0.0, 6.5, "app"),
    ])
    bronze.write_bronze(later, paths.bronze_dir, batch_id="b2", ingested_at=datetime(2025, 2, 2, tzinfo=UTC))
    result = job.run_transforms_incremental(spark, paths)
    got = job.read_silver(spark, paths.silver_dir)
    full = job.resolve_paths(workdir + "-full")
    bronze.write_bronze(first, full.bronze_dir, batch_id="b1", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    bronze.write_bronze(later, full.bronze_dir, batch_id="b2", ingested_at=datetime(2025, 2, 2, tzinfo=UTC))
    job.run_transforms(spark, full)
    assert _same(got, job.read_silver(spark, full.silver_dir))
    assert _same(job.read_fact(spark, paths.fact_dir), job.read_fact(spark, full.fact_dir))
    # t1 moved to zones 3 and 4; zones 1 and 2 stay, named by t2 and the null-id trip
    zones = lambda p: spark.read.parquet(p.zones_dir)
    assert _same(zones(paths), zones(full))
    assert _same(job.read_refs(spark, paths.zones_dir), job.read_refs(spark, full.zones_dir))
    assert result.silver_rows == 3 and result.rewritten_dates == 3
    dates = {r.pickup_date for r in got.select("pickup_date").distinct().collect()}
    assert dates == {date(2025, 1, 2), date(2025, 1, 3)}
    assert got.where(F.col("trip_id").isNull()).first()["payment_type"] == "app"


def test_job_incremental_mode_and_rerun_fallback(spark, workdir):
    common = dict(source="synthetic", days=2, rows_per_day=40, silver_mode="incremental")
    s1 = job.run_job(spark, workdir, run_id="r1", start_date=date(2025, 1, 1), seed=1, **common)
    s2 = job.run_job(spark, workdir, run_id="r2", start_date=date(2025, 1, 2), seed=2, **common)
    assert s1["transforms"]["mode"] == "full" and s2["transforms"]["mode"] == "incremental"
    # a re-run of r2 with other rows: only the full refresh is exact
    s3 = job.run_job(spark, workdir, run_id="r2", start_date=date(2025, 1, 2), seed=3, **common)
    assert s3["transforms"]["mode"] == "full"
    paths = job.resolve_paths(workdir)
    full = job.resolve_paths(workdir + "-full")
    g = generator.generate_trips
    bronze.write_bronze(g(spark, date(2025, 1, 1), 2, 40, 1), full.bronze_dir, batch_id="r1",
                        ingested_at=datetime(2025, 3, 1, tzinfo=UTC))
    bronze.write_bronze(g(spark, date(2025, 1, 2), 2, 40, 3), full.bronze_dir, batch_id="r2",
                        ingested_at=datetime(2025, 3, 2, tzinfo=UTC))
    job.run_transforms(spark, full)
    cols = [c for c in SILVER_COLUMNS if c != "ingested_at"]
    assert _same(job.read_silver(spark, paths.silver_dir).select(*cols),
                 job.read_silver(spark, full.silver_dir).select(*cols))
    runs = audit.latest_runs(audit.read_runs(spark, paths.runs_dir))
    assert runs.count() == 2 and runs.where("status = 'succeeded'").count() == 2


def test_incremental_run_carries_check_counts_forward(spark, workdir, monkeypatch):
    """The report of an incremental run equals a full scan of the silver it left."""
    from faresight.operators import quality
    first = _rows(spark, [
        ("a", _t("2025-01-01 08:00:00"), _t("2025-01-01 08:10:00"), 0, 1.0, 1, 2, 5.0, 0.0, 4.0, "card"),
        ("b", _t("2025-01-01 09:00:00"), _t("2025-01-01 13:00:00"), 2, 1.0, 1, 2, 5.0, 0.0, 5.5, "cash"),
        ("c", _t("2025-01-02 09:00:00"), _t("2025-01-02 09:30:00"), 7, 3.0, 4, 5, 8.0, 1.0, 9.5, "app"),
        (None, _t("2025-01-02 10:00:00"), _t("2025-01-02 10:30:00"), 1, 3.0, 4, 5, 8.0, 1.0, 9.5, "app"),
    ])
    # newer copies: "a" fixed, "c" now fails twice, a new trip "d"; a null id again
    later = _rows(spark, [
        ("a", _t("2025-01-01 08:00:00"), _t("2025-01-01 08:12:00"), 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card"),
        ("c", _t("2025-01-03 09:00:00"), _t("2025-01-03 09:00:30"), 0, 3.0, 4, 5, 8.0, 1.0, 2.0, "app"),
        ("d", _t("2025-01-03 11:00:00"), _t("2025-01-03 11:20:00"), 9, 2.0, 6, 7, 7.0, 0.0, 7.5, "card"),
        (None, _t("2025-01-04 10:00:00"), _t("2025-01-04 10:30:00"), 1, 3.0, 4, 5, 8.0, 1.0, 1.5, "app"),
    ])
    seen = []
    original = quality.quality_report

    def spy(df, expectations, known=None):
        seen.append(dict(known or {}))
        return original(df, expectations, known=known)

    monkeypatch.setattr(job.quality, "quality_report", spy)
    s1 = job.run_job(spark, workdir, run_id="i1", source="frame", trips=first, raise_on_failure=False)
    s2 = job.run_job(spark, workdir, run_id="i2", source="frame", trips=later, raise_on_failure=False)
    assert s1["transforms"]["mode"] == "full" and s2["transforms"]["mode"] == "incremental"
    # the incremental report was computed without reading silver: every check was known
    assert set(seen[-1]) == set(range(1, 9))
    monkeypatch.setattr(job.quality, "quality_report", original)
    paths = job.resolve_paths(workdir)
    scanned = quality.quality_report(job.read_silver(spark, paths.silver_dir),
                                     quality.silver_expectations())
    expected = {r.name: r.failures for r in scanned.collect()}
    assert {c["name"]: c["failures"] for c in s2["quality"]["checks"]} == expected
    assert expected["invalid_passenger_count"] == 2 and expected["invalid_trip_duration"] == 2
    assert expected["total_amount_below_fare"] == 2
    # the dimension kept from reference counts equals the distinct zones of silver
    from faresight.operators import gold
    stored_zones = spark.read.parquet(paths.zones_dir)
    assert _same(stored_zones, gold.dim_zones(job.read_silver(spark, paths.silver_dir), ordered=False))
    assert {r.zone_id for r in stored_zones.collect()} == {1, 2, 4, 5, 6, 7}


def test_interrupted_run_forces_a_full_refresh(spark, workdir, monkeypatch):
    common = dict(source="synthetic", days=1, rows_per_day=30)
    job.run_job(spark, workdir, run_id="u1", start_date=date(2025, 1, 1), seed=1, **common)

    def broken(*args, **kwargs):
        raise RuntimeError("executor lost beyond retries")

    monkeypatch.setattr(job, "run_transforms_incremental", broken)
    failed = job.run_job(spark, workdir, run_id="u2", start_date=date(2025, 1, 2), seed=2,
                         raise_on_failure=False, **common)
    assert failed["status"] == "failed" and "executor lost" in failed["error_message"]
    monkeypatch.undo()
    paths = job.resolve_paths(workdir)
    assert job.read_silver(spark, paths.silver_dir).count() == 30   # u2 is only in bronze
    s3 = job.run_job(spark, workdir, run_id="u3", start_date=date(2025, 1, 3), seed=3, **common)
    assert s3["transforms"]["mode"] == "full"
    assert job.read_silver(spark, paths.silver_dir).count() == 90
    s4 = job.run_job(spark, workdir, run_id="u4", start_date=date(2025, 1, 4), seed=4, **common)
    assert s4["transforms"]["mode"] == "incremental"
    assert job.read_silver(spark, paths.silver_dir).count() == 120


def test_incremental_batch_without_valid_rows(spark, workdir):
    common = dict(source="synthetic", days=1, rows_per_day=25)
    job.run_job(spark, workdir, run_id="v1", start_date=date(2025, 1, 1), seed=1, **common)
    paths = job.resolve_paths(workdir)
    before = job.read_silver(spark, paths.silver_dir)
    before_rows = before.collect()
    junk = _rows(spark, [
        ("z1", _t("2025-01-05 08:00:00"), _t("2025-01-05 08:10:00"), 1, 0.0, 1, 2, 5.0, 0.0, 5.5, "card"),
        ("z2", None, _t("2025-01-05 08:10:00"), 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card"),
    ])
    s2 = job.run_job(spark, workdir, run_id="v2", source="frame", trips=junk)
    assert s2["transforms"]["mode"] == "incremental" and s2["transforms"]["rewritten_dates"] == 0
    assert s2["ingestion"]["rows_written"] == 1 and s2["ingestion"]["rows_rejected"] == 1
    after = job.read_silver(spark, paths.silver_dir)
    assert sorted(after.collect()) == sorted(before_rows)
    scanned = quality.quality_report(after, quality.silver_expectations())
    assert {c["name"]: c["failures"] for c in s2["quality"]["checks"]} == \
        {r.name: r.failures for r in scanned.collect()}


def test_zone_without_references_leaves_the_dimension(spark, workdir):
    paths = job.resolve_paths(workdir)
    first = _rows(spark, [
        ("x", _t("2025-01-01 08:00:00"), _t("2025-01-01 08:10:00"), 1, 1.0, 10, 11, 5.0, 0.0, 5.5, "card"),
        ("y", _t("2025-01-01 09:00:00"), _t("2025-01-01 09:10:00"), 1, 1.0, 12, 12, 5.0, 0.0, 5.5, "card"),
    ])
    later = _rows(spark, [
        ("x", _t("2025-01-01 08:00:00"), _t("2025-01-01 08:11:00"), 1, 1.0, 13, 11, 5.0, 0.0, 5.5, "card"),
    ])
    bronze.write_bronze(first, paths.bronze_dir, batch_id="z1", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    job.run_transforms(spark, paths)
    bronze.write_bronze(later, paths.bronze_dir, batch_id="z2", ingested_at=datetime(2025, 2, 2, tzinfo=UTC))
    result = job.run_transforms_incremental(spark, paths)
    zones = {r.zone_id: r.zone_label for r in spark.read.parquet(paths.zones_dir).collect()}
    assert zones == {11: "Zone 11", 12: "Zone 12", 13: "Zone 13"} and result.dim_zone_rows == 3
    refs = {r.zone_id: r.refs for r in job.read_refs(spark, paths.zones_dir).collect()}
    assert refs == {11: 1, 12: 2, 13: 1}


def _day(spark, day, seed, rows=20):
    return generator.generate_trips(spark, date(2025, 1, day), days=1, rows_per_day=rows, seed=seed)


def test_default_job_folds_in_what_others_wrote(spark, workdir):
    paths = job.resolve_paths(workdir)
    job.run_job(spark, workdir, run_id="w1", source="frame", trips=_day(spark, 1, 1))
    bronze.write_bronze(_day(spark, 2, 2), paths.bronze_dir, batch_id="other", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    last = job.run_job(spark, workdir, run_id="w2", source="frame", trips=_day(spark, 3, 3))
    assert last["transforms"]["mode"] == "incremental" and last["transforms"]["silver_rows"] == 60
    got = job.read_silver(spark, paths.silver_dir)
    assert {r.source_batch_id for r in got.select("source_batch_id").distinct().collect()} == {"w1", "other", "w2"}
    assert last["transforms"]["gold_rows"] == job.read_fact(spark, paths.fact_dir).count()


def test_changed_or_removed_batches_force_a_full_build(spark, workdir):
    from faresight.session import delete_path
    paths = job.resolve_paths(workdir)
    job.run_job(spark, workdir, run_id="w1", source="frame", trips=_day(spark, 1, 1))
    job.run_job(spark, workdir, run_id="w2", source="frame", trips=_day(spark, 2, 2))
    # the same batch again, with other rows on the same day
    bronze.write_bronze(_day(spark, 2, 9, rows=7), paths.bronze_dir, batch_id="w2", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    s3 = job.run_job(spark, workdir, run_id="w3", source="frame", trips=_day(spark, 3, 3))
    assert s3["transforms"]["mode"] == "full" and s3["transforms"]["silver_rows"] == 47
    delete_path(spark, f"{paths.bronze_dir}/pickup_date=2025-01-01")
    s4 = job.run_job(spark, workdir, run_id="w4", source="frame", trips=_day(spark, 4, 4))
    assert s4["transforms"]["mode"] == "full" and job.read_silver(spark, paths.silver_dir).count() == 47


def test_one_run_leaves_another_runs_marker_until_its_rows_are_in(spark, workdir):
    from faresight.session import path_exists, write_text
    paths = job.resolve_paths(workdir)
    job.run_job(spark, workdir, run_id="w1", source="frame", trips=_day(spark, 1, 1))
    stopped = job.pending_marker(paths, "stopped/run")
    write_text(spark, stopped, "stopped/run")
    s2 = job.run_job(spark, workdir, run_id="w2", source="frame", trips=_day(spark, 2, 2))
    assert s2["transforms"]["mode"] == "full" and not path_exists(spark, stopped)
    assert not path_exists(spark, job.pending_marker(paths, "w2"))


def test_a_failed_scan_does_not_block_later_runs(spark, workdir):
    from faresight.session import delete_path, write_text
    paths = job.resolve_paths(workdir)
    write_text(spark, f"{paths.bronze_dir}/broken.parquet", "no parquet")
    failed = job.run_job(spark, workdir, run_id="w1", source="frame", trips=_day(spark, 1, 1), raise_on_failure=False)
    assert failed["status"] == "failed"
    delete_path(spark, f"{paths.bronze_dir}/broken.parquet")
    s2 = job.run_job(spark, workdir, run_id="w2", source="frame", trips=_day(spark, 2, 2))
    assert s2["status"] == "succeeded" and s2["transforms"]["silver_rows"] == 40
