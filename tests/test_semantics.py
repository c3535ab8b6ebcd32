"""One test per semantic decision (SURVEY D-rows) and operator invariants."""

from __future__ import annotations

from datetime import UTC, date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faresight.functions import columns
from faresight.operators import audit, gold, metrics, quality, silver
from faresight.sources import bronze, generator, taxi


def _ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def test_minute_boundaries_not_elapsed_minutes(spark):
    df = spark.createDataFrame(
        [(_ts("2025-01-01 08:00:59"), _ts("2025-01-01 08:01:00")),
         (_ts("2025-01-01 08:00:00"), _ts("2025-01-01 08:00:59")),
         (_ts("2025-01-01 23:59:30"), _ts("2025-01-02 00:00:10")),
         (_ts("1969-12-31 23:59:30"), _ts("1970-01-01 00:00:10")),
         (_ts("2025-01-01 08:10:00"), _ts("2025-01-01 08:00:30"))],
        "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(columns.minute_boundaries("a", "b")).collect()]
    assert got == [1, 0, 1, 1, -10]


def test_round2_is_half_away_from_zero_on_scaled_value(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.675,), (1.005,), (None,)], "x double")
    got = [r[0] for r in df.select(columns.round2("x")).collect()]
    # 2.675 and 1.005 are stored slightly below the half: scaled rounding keeps them down
    assert got == [0.13, -0.13, 2.68, 1.0, None]


def test_fact_means_are_exact_on_half_cents(spark):
    rows = [(date(2025, 1, 1), 8, 1, 1.0, 6.17, 6.17), (date(2025, 1, 1), 8, 1, 1.01, 6.18, 6.18)]
    df = spark.createDataFrame(rows, "pickup_date date, pickup_hour long, pickup_zone_id long, "
                                     "trip_distance double, fare_amount double, total_amount double")
    r = gold.fct_trip_hourly(df).first()
    # exact means are 1.005 and 6.175: half a cent rounds away from zero
    assert (r.trip_count, r.avg_trip_distance, r.avg_fare_amount, r.total_revenue) == (2, 1.01, 6.18, 12.35)


def test_fact_keeps_nan_like_sql_average(spark):
    rows = [(date(2025, 1, 1), 8, 1, float("nan"), 5.0, 5.0), (date(2025, 1, 1), 8, 1, 1.0, 6.0, 6.0)]
    df = spark.createDataFrame(rows, "pickup_date date, pickup_hour long, pickup_zone_id long, "
                                     "trip_distance double, fare_amount double, total_amount double")
    r = gold.fct_trip_hourly(df).first()
    assert r.avg_trip_distance != r.avg_trip_distance  # NaN
    assert r.avg_fare_amount == 5.5


def _bronze_rows(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, pickup_datetime timestamp_ntz, "
                                       "dropoff_datetime timestamp_ntz, passenger_count long, "
                                       "trip_distance double, pickup_zone_id long, dropoff_zone_id long, "
                                       "fare_amount double, tip_amount double, total_amount double, "
                                       "payment_type string, source_batch_id string, ingested_at string")


def test_filter_runs_before_ranking(spark):
    p, d = _ts("2025-01-01 08:00:00"), _ts("2025-01-01 08:10:00")
    rows = [("t1", p, d, 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card", "old", "2025-01-01T00:00:00Z"),
            # newest copy is invalid (zero fare): the older valid copy must survive
            ("t1", p, d, 1, 1.0, 1, 2, 0.0, 0.0, 0.5, "card", "new", "2025-01-02T00:00:00Z")]
    out = silver.silver_trips(_bronze_rows(spark, rows)).collect()
    assert [(r.trip_id, r.source_batch_id) for r in out] == [("t1", "old")]


def test_provenance_defaults_and_iso_offsets(spark):
    p, d = _ts("2025-01-01 08:00:00"), _ts("2025-01-01 08:10:00")
    rows = [("a", p, d, 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card", None, None),
            ("b", p, d, 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card", "x", "2025-01-02T01:00:00+01:00")]
    out = {r.trip_id: r for r in silver.silver_trips(_bronze_rows(spark, rows)).collect()}
    assert out["a"].source_batch_id == "legacy" and out["a"].ingested_at == p
    assert out["b"].ingested_at == _ts("2025-01-02 00:00:00")


def test_null_pickup_is_rejected_not_partitioned(spark, workdir):
    p, d = _ts("2025-01-01 08:00:00"), _ts("2025-01-01 08:10:00")
    trips = _bronze_rows(spark, [("a", p, d, 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card", None, None),
                                 ("b", None, d, 1, 1.0, 1, 2, 5.0, 0.0, 5.5, "card", None, None)])
    res = bronze.write_bronze(trips, workdir, batch_id="b1", ingested_at=datetime(2025, 1, 2, tzinfo=UTC))
    assert (res.rows_read, res.rows_written, res.rows_rejected, res.partitions) == (2, 1, 1, 1)
    assert bronze.scan_bronze(spark, workdir).count() == 1


def test_replay_rewrites_only_dates_it_writes(spark, workdir):
    g = generator.generate_trips(spark, date(2025, 1, 1), days=3, rows_per_day=20, seed=1)
    bronze.write_bronze(g, workdir, batch_id="b", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    first_day = g.where(F.to_date("pickup_datetime") == date(2025, 1, 1)).limit(5)
    bronze.write_bronze(first_day, workdir, batch_id="b", ingested_at=datetime(2025, 2, 2, tzinfo=UTC))
    counts = {r.pickup_date: r["count"] for r in
              bronze.scan_bronze(spark, workdir).groupBy("pickup_date").count().collect()}
    assert counts == {date(2025, 1, 1): 5, date(2025, 1, 2): 20, date(2025, 1, 3): 20}


def test_batch_keys_do_not_collide(spark):
    names = ["a/b", "a_b", "a_b-a7e86136", "run-1", "été 2", "", "~", "~7E", "007", "7", "a+b", "a b", "a*b", "a.b", "%20",
             "=x", "a~b", "日本", "A_B", "a:b?c#d&e"]
    ids = spark.createDataFrame([(n,) for n in names], "b string")
    keys = {r.b: r.k for r in ids.select("b", columns.batch_key("b").alias("k")).collect()}
    assert len(set(keys.values())) == len(names)
    for plain in ("a_b", "run-1", "a_b-a7e86136", "007"):
        assert keys[plain] == plain
    assert keys["a/b"] == "a~2Fb" and keys["été 2"] == "~C3~A9t~C3~A9~202" and keys[""] == "~"
    assert all(columns.batch_key_text(b) == k for b, k in keys.items())


def test_batches_whose_ids_resemble_each_other_keep_their_rows(spark, workdir):
    g = generator.generate_trips(spark, date(2025, 1, 1), days=1, rows_per_day=20, seed=1)
    for n in ("a/b", "a_b-a7e86136", "007", "7", ""):
        bronze.write_bronze(g, workdir, batch_id=n, ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    counts = {r.source_batch_id: r["count"] for r in
              bronze.scan_files(spark, workdir).groupBy("source_batch_id").count().collect()}
    assert counts == dict.fromkeys(["a/b", "a_b-a7e86136", "007", "7", ""], 20)
    kept = {r.batch_key for r in bronze.scan_bronze_layouts(spark, [workdir]).select("batch_key").distinct().collect()}
    assert kept == {"a~2Fb", "a_b-a7e86136", "007", "7", "~"}


def test_fact_keeps_parts_of_cents_and_huge_amounts(spark):
    rows = [(date(2025, 1, 1), 8, 1, 1.0, 0.004, 0.004)] * 1000 + [(date(2025, 1, 1), 8, 2, 1.0, x, x) for x in (10.0, 1e17)]
    df = spark.createDataFrame(rows, "pickup_date date, pickup_hour long, pickup_zone_id long, "
                                     "trip_distance double, fare_amount double, total_amount double")
    got = {r.zone_id: r for r in gold.fct_trip_hourly(df).collect()}
    assert (got[1].total_revenue, got[1].avg_fare_amount) == (4.0, 0.0)
    assert (got[2].total_revenue, got[2].avg_fare_amount) == (1e17 + 10, (1e17 + 10) / 2)


def test_kpis_leave_nan_out_and_show_infinity(spark):
    schema = "trip_count long, avg_fare_amount double, total_revenue double"
    nan, inf = float("nan"), float("inf")
    r = metrics.dashboard_kpis(spark.createDataFrame([(1, 10.0, 1.0), (3, nan, nan)], schema)).first()
    assert (r.total_trips, r.total_revenue, r.avg_fare_unweighted, r.avg_fare_weighted) == (4, 1.0, 10.0, 10.0)
    r = metrics.dashboard_kpis(spark.createDataFrame([(1, 10.0, inf), (3, inf, 2.0)], schema)).first()
    assert (r.total_revenue, r.avg_fare_unweighted, r.avg_fare_weighted) == (inf, inf, inf)


def test_legacy_pandas_bronze_with_nanosecond_times(spark, workdir, tmp_path):
    """Files written by pandas/pyarrow (INT64 nanos, no provenance) merge with current bronze."""
    legacy_root = tmp_path / "legacy"
    legacy = legacy_root / "pickup_date=2025-01-01"
    legacy.mkdir(parents=True)
    table = pa.table({
        "trip_id": ["x1"], "pickup_datetime": pa.array([1735718400000000000], pa.timestamp("ns")),
        "dropoff_datetime": pa.array([1735719000000000000], pa.timestamp("ns")),
        "passenger_count": [1], "trip_distance": [1.5], "pickup_zone_id": [3], "dropoff_zone_id": [4],
        "fare_amount": [7.0], "tip_amount": [1.0], "total_amount": [8.5], "payment_type": ["cash"]})
    pq.write_table(table, str(legacy / "trips_old.parquet"))
    current = workdir + "/current"
    g = generator.generate_trips(spark, date(2025, 1, 1), days=1, rows_per_day=5, seed=2)
    bronze.write_bronze(g, current, batch_id="now", ingested_at=datetime(2025, 1, 3, tzinfo=UTC))
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        merged = bronze.scan_bronze_layouts(spark, [str(legacy_root), current])
        rows = {r.trip_id: r for r in silver.silver_trips(merged).collect()}
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
    assert len(rows) == 6
    assert rows["x1"].pickup_datetime == _ts("2025-01-01 08:00:00")
    assert rows["x1"].source_batch_id == "legacy" and rows["x1"].trip_duration_min == 10


def test_taxi_rejects_unknown_dataset_and_missing_arguments():
    with pytest.raises(ValueError):
        taxi.resolve_sources("purple", source_path="x")
    with pytest.raises(ValueError):
        taxi.resolve_sources("yellow", root="/r")
    assert taxi.resolve_sources("green", root="/r", year=2024, month=3) == \
        ["/r/green_tripdata_2024-03.parquet"]
    assert taxi.month_range((2023, 11), (2024, 2)) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_taxi_normalization_details(spark):
    raw = spark.createDataFrame(
        [(None, "2025-01-01 08:00:00", "junk", "2.9", 1.005, 7.6, None, 3.0, None, 4.0, 1.5),
         (1, "bad", None, "NaN", None, None, 12.0, None, 0.1, None, 7.0)],
        "VendorID long, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
        "passenger_count string, trip_distance double, PULocationID double, DOLocationID double, "
        "fare_amount double, tip_amount double, total_amount double, payment_type double")
    a, b = taxi.normalize_taxi(raw, "yellow").collect()
    assert a.pickup_datetime == _ts("2025-01-01 08:00:00") and a.dropoff_datetime is None
    assert (a.passenger_count, a.pickup_zone_id, a.dropoff_zone_id) == (2, 7, 0)
    assert a.payment_type == "unknown" and b.payment_type == "unknown"   # 1.5 and 7
    assert (b.passenger_count, b.trip_distance, b.fare_amount) == (0, 0.0, 0.0)
    assert a.trip_id.startswith("tlc_") and len(a.trip_id) == 36 and a.trip_id != b.trip_id


def test_trip_identity_ignores_fields_outside_the_key(spark):
    raw = spark.createDataFrame(
        [(1, "2025-01-01 08:00:00", "2025-01-01 08:10:00", "1", 1.0, 1.0, 2.0, 5.0, 0.0, 5.5, 1.0),
         (1, "2025-01-01 08:00:00", "2025-01-01 08:10:00", "3", 9.0, 1.0, 2.0, 5.0, 2.0, 5.5, 2.0)],
        "VendorID long, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
        "passenger_count string, trip_distance double, PULocationID double, DOLocationID double, "
        "fare_amount double, tip_amount double, total_amount double, payment_type double")
    ids = {r.trip_id for r in taxi.normalize_taxi(raw).collect()}
    assert len(ids) == 1


def test_generator_invariants(spark):
    g = generator.generate_trips(spark, date(2025, 1, 1), days=2, rows_per_day=5000, seed=11)
    s = g.agg(F.count("*").alias("n"), F.min("passenger_count").alias("p0"),
              F.max("passenger_count").alias("p1"), F.min("pickup_zone_id").alias("z0"),
              F.max("dropoff_zone_id").alias("z1"), F.min("fare_amount").alias("f0"),
              F.avg("trip_distance").alias("dm"), F.count_distinct("trip_id").alias("ids"),
              F.min(F.unix_seconds(F.col("dropoff_datetime").cast("timestamp"))
                    - F.unix_seconds(F.col("pickup_datetime").cast("timestamp"))).alias("d0"),
              F.max(F.unix_seconds(F.col("dropoff_datetime").cast("timestamp"))
                    - F.unix_seconds(F.col("pickup_datetime").cast("timestamp"))).alias("d1"),
              F.count_distinct(F.to_date("pickup_datetime")).alias("days"),
              F.max(F.abs(F.col("total_amount") - F.col("fare_amount") - F.col("tip_amount") - 0.5))
              .alias("tot")).first()
    assert s.n == 10000 and s.ids == 10000 and s.days == 2
    assert (s.p0, s.p1, s.z0, s.z1) == (1, 5, 1, 50)
    assert s.f0 >= 3.0 and 2.8 < s.dm < 3.2
    assert 180 <= s.d0 and s.d1 <= 2699
    assert s.tot < 0.0051
    labels = {r.payment_type for r in g.select("payment_type").distinct().collect()}
    assert labels == set(generator.PAYMENT_LABELS)


def test_generator_independent_of_partitioning(spark):
    a = generator.generate_trips(spark, date(2025, 1, 1), 1, 3000, seed=5, partitions=1)
    b = generator.generate_trips(spark, date(2025, 1, 1), 1, 3000, seed=5, partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_quality_thresholds_and_gate(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (None, "b"), (9, None), (2, None)],
                               "passenger_count long, trip_id string")
    exps = [quality.Expectation("bad_passengers",
                                (F.col("passenger_count") < 1) | (F.col("passenger_count") > 6),
                                max_failures=1),
            quality.Expectation("dup", unique_key=("trip_id",)),
            quality.unique_test(["trip_id"])]
    rows = {r.name: r for r in quality.quality_report(df, exps).collect()}
    assert (rows["bad_passengers"].failures, rows["bad_passengers"].passed) == (2, False)
    assert rows["dup"].failures == 2          # 'a' twice and null twice
    assert rows["unique_trip_id"].failures == 1  # nulls ignored
    with pytest.raises(quality.QualityGateError):
        quality.evaluate(quality.quality_report(df, exps))
    summary = quality.quality_summary(quality.quality_report(df, exps)).first()
    assert (summary.checks_passed, summary.checks_failed, summary.overall_pass) == (0, 3, False)


def test_missing_audit_table_reads_empty(spark, workdir):
    runs = audit.read_runs(spark, workdir + "/nothing-here")
    assert runs.count() == 0 and "summary_path" in runs.columns
    assert audit.recent_runs(runs).count() == 0


def test_dashboard_kpis_mean_of_means_and_weighted(spark):
    fact = spark.createDataFrame([(date(2025, 1, 1), 1, 1, 1, 1.0, 10.0, 10.0),
                                  (date(2025, 1, 1), 2, 1, 3, 1.0, 20.0, 60.0)],
                                 "pickup_date date, pickup_hour long, zone_id long, trip_count long, "
                                 "avg_trip_distance double, avg_fare_amount double, total_revenue double")
    k = metrics.dashboard_kpis(fact).first()
    assert (k.total_trips, k.total_revenue, k.avg_fare_unweighted, k.avg_fare_weighted) == \
        (4, 70.0, 15.0, 17.5)


def test_audit_rows_from_a_catalog_view(spark):
    runs = spark.createDataFrame([("r1", "succeeded", 10), ("r1", "failed", 12)],
                                 "run_id string, status string, bronze_rows long")
    runs.createOrReplaceTempView("faresight_runs_view")
    stored = audit.read_runs(spark, "faresight_runs_view")
    assert stored.count() == 2 and stored.first()["summary_path"] is None
    assert audit.read_runs(spark, "faresight_no_such_table").count() == 0
    spark.catalog.dropTempView("faresight_runs_view")
