"""Bronze files merged: same rows, runs stay incremental, batches stay replaceable, stops change nothing."""

from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from faresight.plans import job, lease
from faresight.schemas import BRONZE_SCHEMA
from faresight.session import stored_files
from faresight.sources import bronze, generator, merges

COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]
DAY = date(2025, 1, 1)


def _land(spark, root, batch, seed, days=2, rows=20, start=DAY):
    bronze.write_bronze(generator.generate_trips(spark, start, days, rows, seed), job.resolve_paths(root).bronze_dir,
                        batch_id=batch, ingested_at=datetime(2025, 2, 1, hour=seed % 24, tzinfo=UTC))


def _seen(spark, root):
    """The rows of bronze by both scans, which have to agree."""
    where = job.resolve_paths(root).bronze_dir
    rows = sorted(map(str, bronze.scan_files(spark, where).select(*COLUMNS).collect()))
    assert rows == sorted(map(str, bronze.scan_bronze(spark, where).select(*COLUMNS).collect()))
    return rows


def _warehouse(spark, root, batches=4):
    for n in range(batches):
        _land(spark, root, f"b/{n}", seed=n)
    job.run_transforms(spark, job.resolve_paths(root))


def _silver(spark, paths):
    return sorted(map(str, job.read_silver(spark, paths.silver_dir).collect()))


def _built_anew(spark, paths):
    """Silver and fact of a full build over the same bronze."""
    other = job.resolve_paths(paths.root + "-anew")
    other = job.JobPaths(**{**vars(other), "bronze_dir": paths.bronze_dir})
    job.run_transforms(spark, other)
    return _silver(spark, other), sorted(map(str, job.read_fact(spark, other.fact_dir).collect()))


def test_merge_keeps_rows_and_the_next_run_is_incremental(spark, workdir):
    paths = job.resolve_paths(workdir)
    _warehouse(spark, workdir)
    before = _seen(spark, workdir)
    merge = job.merge_bronze(spark, workdir, least_files=4)
    assert (merge.dates, merge.files_before, merge.files_after, merge.rows) == (2, 8, 2, len(before))
    assert stored_files(spark, [paths.bronze_dir]).count() == 0
    assert _seen(spark, workdir) == before
    assert job.merge_bronze(spark, workdir, least_files=4) is None
    _land(spark, workdir, "b/new", seed=9, start=date(2025, 1, 2))
    assert len(job.unfolded_files(spark, paths, job._listed(spark, paths))) == 2
    assert job.run_transforms_incremental(spark, paths).mode == "incremental"
    silver, fact = _built_anew(spark, paths)
    assert _silver(spark, paths) == silver
    assert sorted(map(str, job.read_fact(spark, paths.fact_dir).collect())) == fact


def test_merged_batch_written_again_replaces_its_dates_only(spark, workdir):
    paths = job.resolve_paths(workdir)
    _warehouse(spark, workdir)
    job.merge_bronze(spark, workdir, least_files=4)
    _land(spark, workdir, "b/1", seed=20, days=1)   # the first of the batch's two dates
    rows = bronze.scan_files(spark, paths.bronze_dir)
    got = {(r.source_batch_id, r.pickup_date.day, r.ingested_at): r["count"]
           for r in rows.groupBy("source_batch_id", "pickup_date", "ingested_at").count().collect()}
    assert got[("b/1", 1, "2025-02-01T20:00:00Z")] == 20 and got[("b/1", 2, "2025-02-01T01:00:00Z")] == 20
    assert ("b/1", 1, "2025-02-01T01:00:00Z") not in got and sum(got.values()) == 160
    assert {r.pickup_date.day for r in bronze.batch_partitions(spark, paths.bronze_dir, "b~2F1").collect()} == {1, 2}
    assert job.unfolded_files(spark, paths, job._listed(spark, paths)) is None
    # not all of the date is in silver: nothing is merged until it is
    assert job.merge_bronze(spark, workdir, least_files=1) is None
    assert job.run_transforms_incremental(spark, paths).mode == "full"
    assert (_silver(spark, paths), ) == _built_anew(spark, paths)[:1]
    before = _seen(spark, workdir)
    again = job.merge_bronze(spark, workdir, least_files=2)
    assert again.dates == 1 and again.rows == 80   # the merged file of the date and the folder
    assert _seen(spark, workdir) == before
    assert job.unfolded_files(spark, paths, job._listed(spark, paths)) == []


def test_a_second_merge_drops_the_first(spark, workdir):
    paths = job.resolve_paths(workdir)
    _warehouse(spark, workdir, batches=3)
    first = job.merge_bronze(spark, workdir, least_files=3)
    for n in range(3, 6):
        _land(spark, workdir, f"b/{n}", seed=n)
    job.run_transforms_incremental(spark, paths)
    before = _seen(spark, workdir)
    second = job.merge_bronze(spark, workdir, least_files=4)
    assert second.files_before == 8 and second.files_after == 2 and second.rows == len(before)
    assert _seen(spark, workdir) == before
    left = [p.rsplit("/", 1)[1] for p in merges._folders(spark, paths.bronze_dir)]
    assert left == [second.id] and first.id not in left
    assert job.unfolded_files(spark, paths, job._listed(spark, paths)) == []


def test_batches_are_packed_into_bins_and_large_folders_stay(spark, workdir):
    paths = job.resolve_paths(workdir)
    _warehouse(spark, workdir, batches=6)
    _land(spark, workdir, "big", seed=12, days=1, rows=4000)
    job.run_transforms(spark, paths)
    before = _seen(spark, workdir)
    one = stored_files(spark, [paths.bronze_dir]).agg(F.min("length")).first()[0]
    merge = job.merge_bronze(spark, workdir, target_bytes=int(one * 3.5), least_files=4)
    assert merge.files_before == 12 and merge.files_after == 4   # batches that start in the first 3.5 sizes, and the rest
    assert _seen(spark, workdir) == before
    held = spark.read.parquet(f"{merges.merged_dir(paths.bronze_dir)}/{merge.id}/held")
    assert held.groupBy("pickup_date", "batch_key").count().where("count > 1").isEmpty()
    assert stored_files(spark, [paths.bronze_dir]).count() == 1


class Stop(Exception):
    pass


@pytest.mark.parametrize("at", ["counted", "manifest", "deleting"])
def test_a_merge_that_stops_changes_nothing_and_is_finished(spark, workdir, monkeypatch, at):
    paths = job.resolve_paths(workdir)
    _warehouse(spark, workdir)
    before = _seen(spark, workdir)

    def stop(*_, **__):
        raise Stop

    with monkeypatch.context() as patched:
        if at == "counted":       # the new files are written and do not count
            patched.setattr(merges, "create_text", stop)
        elif at == "manifest":    # they count, the manifest names the old ones
            write, calls = job._write_manifest, []
            patched.setattr(job, "_write_manifest", lambda *a: stop() if calls else (calls.append(1), write(*a)))
        else:                     # one of the replaced files is deleted
            delete = merges.delete_files

            def first_only(spark, files):
                files = list(files)
                delete(spark, files[:1])
                return stop() if files else 0

            patched.setattr(merges, "delete_files", first_only)
        with pytest.raises(Stop):
            job.merge_bronze(spark, workdir, least_files=4)
    assert _seen(spark, workdir) == before
    assert job.unfolded_files(spark, paths, job._listed(spark, paths)) == []
    merged = job.merge_bronze(spark, workdir, least_files=4)
    assert (merged is not None) == (at == "counted")
    assert _seen(spark, workdir) == before and stored_files(spark, [paths.bronze_dir]).count() == 0
    assert job.unfolded_files(spark, paths, job._listed(spark, paths)) == []


def test_a_batch_written_again_between_merge_and_deletion_stays(spark, workdir, monkeypatch):
    paths = job.resolve_paths(workdir)
    _warehouse(spark, workdir)
    delete = merges.delete_replaced

    def late(*a):
        if merges._folders(spark, paths.bronze_dir):
            _land(spark, workdir, "b/2", seed=21, days=1)
        return delete(*a)

    with monkeypatch.context() as patched:
        patched.setattr(merges, "delete_replaced", late)
        job.merge_bronze(spark, workdir, least_files=4)
    got = bronze.scan_files(spark, paths.bronze_dir).where("source_batch_id = 'b/2'").groupBy("pickup_date", "ingested_at").count()
    assert {(r.pickup_date.day, r.ingested_at[11:13], r["count"]) for r in got.collect()} == {(1, "21", 20), (2, "02", 20)}
    assert job.unfolded_files(spark, paths, job._listed(spark, paths)) is None


def test_older_layouts_and_rows_without_a_batch_stay_as_they_are(spark, workdir):
    paths = job.resolve_paths(workdir)
    trips = generator.generate_trips(spark, DAY, 1, 10, 5)
    bronze.legacy_payload(trips).drop("pickup_date").write.parquet(f"{paths.bronze_dir}/pickup_date={DAY}/old.parquet")
    nameless = generator.generate_trips(spark, DAY, 1, 10, 6).withColumns(
        {"source_batch_id": F.lit(None).cast("string"), "ingested_at": F.lit("2025-02-01T00:00:00Z")})
    bronze.write_bronze(nameless, paths.bronze_dir)
    for n in range(3):
        _land(spark, workdir, f"b/{n}", seed=n, days=1)
    job.run_transforms(spark, paths)
    seen = lambda: sorted(map(str, bronze.scan_files(spark, paths.bronze_dir).select(*COLUMNS).collect()))
    before = seen()
    merge = job.merge_bronze(spark, workdir, least_files=3)
    assert merge.files_before == 3 and merge.rows == 60 and seen() == before
    assert job.unfolded_files(spark, paths, job._listed(spark, paths)) == []


def test_a_merge_that_lost_its_lease_does_not_count(spark, workdir, monkeypatch):
    paths = job.resolve_paths(workdir)
    _warehouse(spark, workdir)
    before = _seen(spark, workdir)
    merge_files = merges.merge_files

    def lost(*a, **k):
        def gone():
            raise lease.LeaseLost("taken over")
        return merge_files(*a, **{**k, "ready": gone})

    with monkeypatch.context() as patched:
        patched.setattr(merges, "merge_files", lost)
        with pytest.raises(lease.LeaseLost):
            job.merge_bronze(spark, workdir, least_files=4)
    assert not merges._folders(spark, paths.bronze_dir) and _seen(spark, workdir) == before


def test_nothing_to_merge(spark, workdir):
    assert job.merge_bronze(spark, workdir) is None
    _land(spark, workdir, "b", seed=1)
    assert job.merge_bronze(spark, workdir, least_files=1) is None   # silver holds nothing yet
