"""Layouts of files from footers that tasks read and a table keeps (S1, S3)."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from faresight.session import list_matches
from faresight.sources import bronze, fixtures, layouts, taxi
from tests.conftest import SF_SMALL


def local(path: str) -> str:
    return "/" + path.split(":", 1)[-1].lstrip("/")


@pytest.fixture()
def months(spark, workdir):
    """Three monthly files in two layouts, and one of them spelled with a blank."""
    raw = fixtures.raw_taxi_from_events(fixtures.table(spark, SF_SMALL, "events")).limit(50)
    full = taxi.monthly_path(workdir, "yellow", 2024, 1)
    raw.coalesce(1).write.parquet(full)
    raw.drop("VendorID").coalesce(1).write.parquet(taxi.monthly_path(workdir, "yellow", 2024, 2))
    raw.withColumn("extra", F.lit(1)).coalesce(1).write.parquet(f"{workdir}/a month.parquet")
    return workdir


def spoil(path: str) -> None:
    """Other bytes of the same length and time of change: nobody can read the footer any more."""
    at = os.stat(path)
    with open(path, "wb") as out:
        out.write(b"x" * at.st_size)
    os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))


def test_wanted_columns_tell_layouts_apart(spark, months):
    files = layouts.files_of(spark, [months])
    assert sorted(len(x.paths) for x in layouts.by_layout(spark, files)) == [1, 1, 1]
    found = layouts.by_layout(spark, files, wanted=taxi.raw_columns("yellow"))
    assert sorted(len(x.paths) for x in found) == [1, 2]
    assert {"VendorID" in x.columns for x in found} == {True, False}
    assert taxi.read_taxi(spark, "yellow", [months]).count() == 150


def test_kept_footers_are_read_once(spark, months):
    kept = f"{months}-layouts"
    first = layouts.by_layout(spark, layouts.files_of(spark, [months]), kept)
    old = [p for x in first for p in x.paths]
    new = f"{months}/new.parquet"
    spark.range(3).coalesce(1).write.parquet(new)
    for path in old:
        spoil(local(path))
    again = layouts.by_layout(spark, layouts.files_of(spark, [months]), kept)
    assert [x for x in again if x.columns != ("id",)] == first
    assert [len(x.paths) for x in again if x.columns == ("id",)] == [1]
    # a file that changed is another file
    os.utime(local(old[0]), ns=(1, 1))
    with pytest.raises(Exception, match="[Pp]arquet"):
        layouts.by_layout(spark, layouts.files_of(spark, [months]), kept)


def test_layouts_found_twice_are_one(spark, months):
    kept = f"{months}-layouts"
    files = layouts.files_of(spark, [months])
    first = layouts.by_layout(spark, files, kept)
    stored = [p for p in list_matches(spark, f"{kept}/*")]
    shutil.copytree(local(stored[0]), local(stored[0]) + "-of-another-run")
    assert layouts.by_layout(spark, files, kept) == first


def jobs_of(spark, group, action) -> int:
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_files(spark, months, workdir):
    few, many = f"{workdir}-few", f"{workdir}-many"
    one = local(list_matches(spark, f"{months}/yellow_tripdata_2024-01.parquet/*.parquet")[0])
    for folder, n in ((few, 2), (many, 60)):
        os.makedirs(local(folder))
        for i in range(n):
            shutil.copy(one, f"{local(folder)}/{i:03d}.parquet")
    counts = []
    for folder, n in ((few, 2), (many, 60)):
        found = []
        counts.append(jobs_of(spark, folder, lambda: found.extend(
            layouts.by_layout(spark, layouts.files_of(spark, [folder])))))
        assert [len(x.paths) for x in found] == [n]
    assert counts[0] == counts[1] <= 2


def test_nothing_to_read(spark, workdir):
    assert layouts.by_layout(spark, layouts.files_of(spark, [])) == []
    with pytest.raises(AnalysisException):
        taxi.read_taxi(spark, "yellow", [f"{workdir}/none.parquet"])
    os.makedirs(local(workdir))
    with pytest.raises(ValueError, match="no taxi files"):
        taxi.read_taxi(spark, "yellow", [workdir])


def test_older_bronze_files_by_kept_layouts(spark, workdir):
    trips = fixtures.trips(spark, SF_SMALL).limit(40)
    bronze.legacy_payload(trips).write.partitionBy("pickup_date").parquet(workdir)
    kept = f"{workdir}-layouts"
    first = bronze.scan_files(spark, workdir, layouts=kept).count()
    assert first == 40 == bronze.scan_files(spark, workdir, layouts=kept).count()
    known = spark.read.option("recursiveFileLookup", "true").parquet(kept)
    assert known.count() == known.select("path").distinct().count() > 0
