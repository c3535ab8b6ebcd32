"""Exact sums, the fact kept by differences, and the id table beside silver."""

from __future__ import annotations

import glob
import math
import os
import random
from datetime import UTC, date, datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from faresight.functions import columns
from faresight.operators import gold, metrics
from faresight.plans import job
from faresight.sources import bronze, tripdates

TRIP = ("trip_id string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count long, "
        "trip_distance double, pickup_zone_id long, dropoff_zone_id long, fare_amount double, tip_amount double, "
        "total_amount double, payment_type string")


def _trip(name, day, hour=8, zone=1, fare=5.0, total=5.5, distance=1.0):
    start = datetime(2025, 1, day, hour)
    return (name, start, start + timedelta(minutes=10), 1, distance, zone, 2, fare, 0.0, total, "card")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _ingest(spark, paths, rows, batch, day):
    bronze.write_bronze(spark.createDataFrame(rows, TRIP), paths.bronze_dir, batch_id=batch,
                        ingested_at=datetime(2025, 2, day, tzinfo=UTC))


def _equals_full_build(spark, paths, batches, workdir):
    full = job.resolve_paths(f"{workdir}-full")
    for day, (batch, rows) in enumerate(batches, 1):
        _ingest(spark, full, rows, batch, day)
    job.run_transforms(spark, full)
    assert _same(job.read_silver(spark, paths.silver_dir), job.read_silver(spark, full.silver_dir))
    assert _same(job.read_fact(spark, paths.fact_dir), job.read_fact(spark, full.fact_dir))
    assert _same(spark.read.parquet(paths.zones_dir), spark.read.parquet(full.zones_dir))
    assert _same(job.read_refs(spark, paths.zones_dir), job.read_refs(spark, full.zones_dir))
    assert _same(job.read_sums(spark, paths.fact_dir), job.read_sums(spark, full.fact_dir))


AMOUNTS = [0.0, -0.0, 0.1, 1e-9, -7.25, 999999999999999.9, 1e15, -1e15, 1.5e15, 2.0 ** 60 + 256, 3e22, -3e22, 9.9e27, 123.455]


def _amounts(spark, rows):
    """(group, amount) as trips, one hour and zone per group."""
    data = [(date(2025, 1, 1), 1, g, 1.0, a, a) for g, a in rows]
    return spark.createDataFrame(data, "pickup_date date, pickup_hour long, pickup_zone_id long, trip_distance double, "
                                       "fare_amount double, total_amount double")


def test_sums_are_those_of_fractions_in_any_order(spark):
    rng = random.Random(8)
    rows = [(g, rng.choice(AMOUNTS) * rng.choice([1, 1, rng.random()])) for g in range(12) for _ in range(rng.randint(1, 60))]
    results = []
    for parts in (1, 3, 11):
        rng.shuffle(rows)
        results.append(sorted(gold.fct_trip_hourly(_amounts(spark, rows).repartition(parts)).collect()))
    assert results[0] == results[1] == results[2]
    for r in results[0]:
        own = [a for g, a in rows if g == r.zone_id]
        # amounts below BIG count with nine digits after the point
        true = sum(Fraction(a) if abs(a) >= columns.BIG else Fraction(round(Fraction(repr(a)) * 10 ** 9), 10 ** 9) for a in own)
        assert math.isclose(r.total_revenue, float(true), rel_tol=1e-15, abs_tol=0.0051)
        assert math.isclose(r.avg_fare_amount, float(true / len(own)), rel_tol=1e-15, abs_tol=0.0051)
    kpis = {tuple(metrics.dashboard_kpis(gold.fct_trip_hourly(_amounts(spark, rows).repartition(p))).first()) for p in (1, 5, 9)}
    assert len(kpis) == 1


def test_sums_change_by_what_comes_and_goes(spark):
    rng = random.Random(9)
    odd = [math.nan, math.inf, -math.inf, None, *AMOUNTS]
    rows = [(g, rng.choice(odd) if g % 3 else rng.choice(AMOUNTS)) for g in range(9) for _ in range(25)]
    first, removed, added = rows[:150], rows[20:140], rows[150:]
    kept = first[:20] + first[140:] + added
    changed = gold.changed_sums(gold.stored_sums(gold.hourly_sums(_amounts(spark, first))), _amounts(spark, added),
                                _amounts(spark, removed))
    whole = gold.stored_sums(gold.hourly_sums(_amounts(spark, kept)))

    def plain(df):
        # a group without amounts in a part has null there when summed, and 0 when changed
        return sorted(map(str, gold.fact_from_sums(df).collect())), sorted(
            map(str, df.select("zone_id", "trip_count", *[F.coalesce(F.col(f"total_amount_{k}"), F.lit(0)).alias(k)
                                                          for k in ("high", "low", "fit", "nan", "up", "down", "beyond")]).collect()))
    assert plain(changed) == plain(whole)


def test_a_batch_reads_no_silver_beyond_its_dates(spark, workdir, monkeypatch):
    """Files of all other dates are spoilt: whoever reads one of them fails."""
    monkeypatch.setattr(tripdates, "BUCKET_IDS", 4)
    paths = job.resolve_paths(workdir)
    first = [_trip(f"t{i}", 1 + i % 9, zone=i % 4) for i in range(45)] + [_trip(None, 4)]
    _ingest(spark, paths, first, "b1", 1)
    job.run_transforms(spark, paths)
    state = job.read_text(spark, job.state_path(paths.silver_dir))
    table = tripdates.opened(spark, paths.silver_dir, state)
    assert table.buckets == 12 and table.rows().count() == 46
    later = [_trip("t3", 7, fare=9.0, total=11.0), _trip("new", 7)]   # t3 was on the 4th
    _ingest(spark, paths, later, "b2", 2)
    files = glob.glob(f"{paths.silver_dir.removeprefix('file:')}/pickup_date=*/*.parquet")
    spoilt = {f: open(f, "rb").read() for f in files if "2025-01-04" not in f and "2025-01-07" not in f}
    assert len(spoilt) >= 7
    for f in spoilt:
        with open(f, "wb") as out:
            out.write(b"no parquet")
    read, original = [], gold.hourly_sums
    monkeypatch.setattr(gold, "hourly_sums", lambda trips: (read.extend(trips.inputFiles()), original(trips))[1])
    result = job.run_transforms_incremental(spark, paths)
    monkeypatch.undo()
    assert result.rewritten_dates == 2 and read and not any("/silver/" in f for f in read)
    for f, content in spoilt.items():
        with open(f, "wb") as out:
            out.write(content)
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        assert os.path.exists(crc)
    _equals_full_build(spark, paths, [("b1", first), ("b2", later)], workdir)
    # the scan of the table is limited to the ids' own buckets
    ids = spark.createDataFrame([("t3", date(2025, 1, 7))], "trip_id string, pickup_date date")
    again = tripdates.opened(spark, paths.silver_dir, job.read_text(spark, job.state_path(paths.silver_dir)))
    assert again.appends == 1
    found = again.dates_of(ids, f"{workdir}/pairs")
    assert {r.pickup_date.day for r in found.collect()} == {4, 7}
    # ... and spoilt files of other buckets are not read either
    own = spark.range(1).select(F.lit("t3").alias("trip_id")).select(tripdates.bucket_of(again.buckets)).first()[0]
    for f in glob.glob(f"{again.location.removeprefix('file:')}/bucket=*/*.parquet"):
        if f"/bucket={own}/" not in f:
            with open(f, "wb") as out:
                out.write(b"no parquet")
    assert again.dates_of(ids, f"{workdir}/pairs-again").count() == 2


def _stop(monkeypatch, name, when):
    original = getattr(job, name)

    def stopping(*args, **kwargs):
        if when(*args, **kwargs):
            raise RuntimeError("stopped")
        return original(*args, **kwargs)
    monkeypatch.setattr(job, name, stopping)


@pytest.mark.parametrize("place", ["silver", "sums", "fact", "state"])
def test_a_stop_at_any_place_is_made_good_by_the_next_run(spark, workdir, monkeypatch, place):
    paths = job.resolve_paths(workdir)
    first = [_trip(f"t{i}", 1 + i % 3, zone=i % 4) for i in range(12)]
    later = [_trip("t0", 5, zone=7), _trip("t1", 2, fare=8.0), _trip("x", 2)]
    _ingest(spark, paths, first, "b1", 1)
    job.run_transforms(spark, paths)
    _ingest(spark, paths, later, "b2", 2)
    if place == "state":
        _stop(monkeypatch, "_new_state", lambda *a, **k: True)
    else:
        _stop(monkeypatch, "_write_by_date", lambda df, path, label, *a, **k: label == place)
    with pytest.raises(RuntimeError):
        job.run_transforms_incremental(spark, paths)
    monkeypatch.undo()
    job.run_transforms_incremental(spark, paths)
    _equals_full_build(spark, paths, [("b1", first), ("b2", later)], workdir)


def test_amounts_beyond_exact_sums_are_summed_anew(spark, workdir):
    paths = job.resolve_paths(workdir)
    first = [_trip(f"t{i}", 1, total=t) for i, t in enumerate([1e40, 2.5, 3e39, 4.0])] + [_trip("n", 2, total=math.nan),
                                                                                          _trip("i", 2, zone=3, total=math.inf)]
    later = [_trip("t0", 1, total=7.5), _trip("n", 2, total=1.0), _trip("i", 3, total=2.0)]
    _ingest(spark, paths, first, "b1", 1)
    job.run_transforms(spark, paths)
    _ingest(spark, paths, later, "b2", 2)
    job.run_transforms_incremental(spark, paths)
    got = {(r.pickup_date.day, r.zone_id): r.total_revenue for r in job.read_fact(spark, paths.fact_dir).collect()}
    assert got == {(1, 1): 3e39, (2, 1): 1.0, (3, 1): 2.0}
    assert _same(job.read_fact(spark, paths.fact_dir), gold.fct_trip_hourly(job.read_silver(spark, paths.silver_dir)))


def test_the_id_table_is_written_anew_after_many_appends(spark, workdir, monkeypatch):
    monkeypatch.setattr(tripdates, "MOST_APPENDS", 2)
    paths, batches = job.resolve_paths(workdir), []
    for n in range(4):
        batches.append((f"b{n}", [_trip("a", 1 + n), _trip(f"only{n}", 2)]))
        _ingest(spark, paths, batches[-1][1], batches[-1][0], n + 1)
        (job.run_transforms_incremental if n else job.run_transforms)(spark, paths)
        table = tripdates.opened(spark, paths.silver_dir, job.read_text(spark, job.state_path(paths.silver_dir)))
        assert table.appends < 2
        # every row of silver has its date in the table
        own = tripdates.foreign(job.read_silver(spark, paths.silver_dir))
        assert own.exceptAll(table.rows().select("trip_id", "pickup_date").distinct()).count() == 0
    assert len(glob.glob(f"{paths.silver_dir.removeprefix('file:')}.ids-*")) == 1
    _equals_full_build(spark, paths, batches, workdir)


def test_ids_made_from_trips_have_no_entries(spark, workdir):
    paths = job.resolve_paths(workdir)
    _ingest(spark, paths, [_trip("tlc_abc", 1), _trip("tlc_abd", 2)], "b1", 1)
    job.run_transforms(spark, paths)
    table = tripdates.opened(spark, paths.silver_dir, job.read_text(spark, job.state_path(paths.silver_dir)))
    assert table is not None and table.rows().count() == 0
    _ingest(spark, paths, [_trip("tlc_abc", 1, fare=6.0), _trip("tlc_abe", 3)], "b2", 2)
    result = job.run_transforms_incremental(spark, paths)
    assert result.silver_rows == 3 and result.rewritten_dates == 2


def test_new_entries_are_computed_once(spark, workdir):
    """Adding a batch's ids to the table evaluates its trips once; an append without new entries does not count."""
    held = spark.createDataFrame([(f"t{i}", date(2025, 1, 1)) for i in range(6)], tripdates.PAIRS_SCHEMA)
    table = tripdates.rebuild(spark, f"{workdir}/silver", held, 6)
    seen = spark.sparkContext.accumulator(0)
    name = F.udf(lambda x: seen.add(1) or f"t{x}", "string").asNondeterministic()
    batch = spark.range(0, 10, 1, 2).select(name("id").alias("trip_id"), F.lit(date(2025, 1, 2)).alias("pickup_date"))
    grown = table.with_trips(batch, held)
    assert seen.value == 10 and grown.appends == 1
    assert _same(grown.rows().select("trip_id", "pickup_date"),
                 held.unionByName(spark.createDataFrame([(f"t{i}", date(2025, 1, 2)) for i in range(10)], tripdates.PAIRS_SCHEMA)))
    assert grown.with_trips(held, held) == grown
