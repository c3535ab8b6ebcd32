"""Physical-plan properties the scale design relies on, and a skewed-key run."""

from __future__ import annotations

import contextlib
import io
from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from faresight.operators import audit, gold, quality, silver
from faresight.plans import job
from faresight.sources import bronze, generator


def _plan(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def _bronze(spark, workdir):
    paths = job.resolve_paths(workdir)
    g = generator.generate_trips(spark, date(2025, 1, 1), days=2, rows_per_day=300, seed=4)
    bronze.write_bronze(g, paths.bronze_dir, batch_id="p1", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    return paths, bronze.scan_bronze(spark, paths.bronze_dir)


def test_silver_limits_copies_before_the_shuffle_and_pushes_filters(spark, workdir):
    _, b = _bronze(spark, workdir)
    plan = _plan(silver.silver_trips(b))
    # node details are listed bottom-up: partial top-1 per trip, then the
    # exchange on trip_id, then the final top-1
    partial = plan.index("row_number(), 1, Partial")
    exchange = plan.index("hashpartitioning(trip_id")
    final = plan.index("row_number(), 1, Final")
    assert partial < exchange < final
    assert "GreaterThan(trip_distance,0.0)" in plan and "GreaterThan(fare_amount,0.0)" in plan


def test_aggregates_are_hash_based_and_partial(spark, workdir):
    _, b = _bronze(spark, workdir)
    s = silver.silver_trips(b)
    for df in (gold.fct_trip_hourly(s), gold.dim_zones(s, ordered=False),
               quality.quality_report(s, quality.silver_expectations()), audit.batch_lineage(b)):
        plan = _plan(df)
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
        # every aggregation is a pair: map-side (partial) hash aggregate, then the final one
        tree = plan.split("\n\n")[0]
        n = tree.count("HashAggregate")
        assert n >= 2 and n % 2 == 0
    assert "Broadcast" not in _plan(gold.fct_trip_hourly(s))


def test_scans_read_only_needed_columns(spark, workdir):
    _, b = _bronze(spark, workdir)
    plan = _plan(gold.dim_zones(silver.valid_trips(b).select("pickup_zone_id", "dropoff_zone_id"),
                                ordered=False))
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "pickup_zone_id" in read and "payment_type" not in read and "trip_id" not in read


def test_hot_trip_id_with_a_third_of_rows(spark, workdir):
    """One trip id (and the null id) holding a third of all rows still yields one row each."""
    g = generator.generate_trips(spark, date(2025, 1, 1), days=1, rows_per_day=3000, seed=9)
    n = F.monotonically_increasing_id()
    skewed = (g.withColumn("_n", n)
               .withColumn("trip_id", F.when(F.col("_n") % 3 == 0, F.lit("hot"))
                                       .when(F.col("_n") % 3 == 1, F.lit(None))
                                       .otherwise(F.col("trip_id")))
               .drop("_n"))
    paths = job.resolve_paths(workdir)
    bronze.write_bronze(skewed, paths.bronze_dir, batch_id="s", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    job.run_transforms(spark, paths)
    s = job.read_silver(spark, paths.silver_dir)
    counts = {r.trip_id: r["count"] for r in s.groupBy("trip_id").count()
              .where(F.col("trip_id").isNull() | (F.col("trip_id") == "hot")).collect()}
    assert counts == {"hot": 1, None: 1}
    assert s.count() == 1000 + 2
    # the winner of the hot id is the newest (latest dropoff, then the tie-break order)
    expected = (skewed.where("trip_id = 'hot'").orderBy(F.col("dropoff_datetime").desc(),
                                                        F.col("pickup_datetime").desc(),
                                                        F.col("fare_amount").desc(),
                                                        F.col("total_amount").desc(),
                                                        F.col("trip_distance").desc(),
                                                        F.col("tip_amount").desc(),
                                                        F.col("passenger_count").desc(),
                                                        F.col("pickup_zone_id").desc(),
                                                        F.col("dropoff_zone_id").desc(),
                                                        F.col("payment_type").desc()).first())
    got = s.where("trip_id = 'hot'").first()
    assert (got.dropoff_datetime, got.fare_amount) == (expected.dropoff_datetime, expected.fare_amount)


def test_shuffles_are_sized_by_input_bytes(spark):
    from faresight.session import shuffle_settings, sized_for
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # small input: the configured count is the floor
    assert shuffle_settings(spark, 1000) == {key: str(floor)}
    # about two bytes shuffled for a stored byte, 128 MB per partition, at any size
    for stored in (10**12, 100 * 10**12, 10**15):
        assert int(shuffle_settings(spark, stored)[key]) == -(-2 * stored // (128 << 20))
    # applied inside the block only; a count set by the caller is kept
    with sized_for(spark, 10**12):
        assert spark.conf.get(key) == shuffle_settings(spark, 10**12)[key]
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "17")
    try:
        with sized_for(spark, 10**12):
            assert spark.conf.get(key) == "17"
    finally:
        spark.conf.unset(key)


def test_the_session_keeps_its_overwrite_mode(spark, workdir):
    """A user's own overwrite of a partitioned table still replaces the whole table."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    paths, _ = _bronze(spark, workdir)
    job.run_transforms(spark, paths)
    assert spark.conf.get(key) == before
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{workdir}/own")
    spark.range(1).withColumn("p", F.lit(1)).write.mode("overwrite").partitionBy("p").parquet(f"{workdir}/own")
    assert spark.read.parquet(f"{workdir}/own").count() == 1


def test_stored_files_are_listed_without_reading_them(spark, workdir):
    from faresight.session import stored_bytes, stored_files
    spark.range(100).repartition(3).write.parquet(f"{workdir}/a/x=1")
    listed = stored_files(spark, [f"{workdir}/a", f"{workdir}/nothing"])
    assert listed.count() == 3 and stored_bytes(spark, [f"{workdir}/a"]) > 0
    assert "content" not in _plan(listed) and stored_bytes(spark, [f"{workdir}/nothing"]) == 0


def test_reports_scan_the_source_once_and_shuffle_trip_ids_once(spark):
    from faresight.plans.registry import registered
    sf = "/root/testdata/sf0.001"
    report = registered()["quality_report"].build(spark, sf)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("hashpartitioning(trip_id") == 1
    # these read silver as it was written once; nothing of it is built or shuffled by trip again
    for name in ("column_tests", "layer_counts"):
        plan = _plan(registered()[name].build(spark, sf))
        assert "events.parquet" not in plan and "hashpartitioning(trip_id" not in plan


def test_checks_counted_by_the_silver_write_equal_a_scan(spark, workdir):
    paths, b = _bronze(spark, workdir)
    checks = quality.silver_expectations()
    # the per-trip counts ride on the newest-per-trip window: no new exchange or sort
    annotated = quality.with_key_copies(
        silver.silver_trips(b), ["trip_id"],
        silver.newest_first_order(silver.RECENCY_ORDER, silver.TIE_BREAK_ORDER))
    tree = _plan(annotated.hint("rebalance", "pickup_date")).split("\n\n")[0]
    assert tree.count("Exchange") == 2 and tree.count("Sort") == 2
    result = job.run_transforms(spark, paths, checks)
    assert set(result.check_counts) == set(range(1, 9))
    stored = job.read_silver(spark, paths.silver_dir)
    assert quality.COPIES_COL not in stored.columns
    fused = quality.quality_report(stored, checks, known=result.check_counts)
    # every check was counted while silver was written: the report reads nothing
    assert "Scan parquet" not in _plan(fused)
    scanned = quality.quality_report(stored, checks)
    assert sorted(fused.collect()) == sorted(scanned.collect())


def test_hot_date_is_split_into_several_files(spark, workdir):
    """A date holding most rows is written as several files, the light dates as few."""
    import glob

    g = generator.generate_trips(spark, date(2025, 1, 1), days=4, rows_per_day=2000, seed=3)
    hot = g.withColumn("pickup_datetime",
                       F.when(F.col("passenger_count") <= 4,
                              F.col("pickup_datetime") - F.make_dt_interval(F.datediff(
                                  F.to_date("pickup_datetime"), F.lit(date(2025, 1, 1)))))
                        .otherwise(F.col("pickup_datetime")))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        out = job.resolve_paths(workdir).bronze_dir
        bronze.write_bronze(hot, out, batch_id="hot", ingested_at=datetime(2025, 2, 1, tzinfo=UTC))
    finally:
        spark.conf.set(key, before)
    local = out.removeprefix("file:")
    files = {d: len(glob.glob(f"{local}/pickup_date={d}/batch_key=hot/*.parquet"))
             for d in ("2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04")}
    assert files["2025-01-01"] > 1
    assert files["2025-01-01"] > max(files[d] for d in files if d != "2025-01-01")
    assert bronze.scan_bronze(spark, out).count() == 8000


def test_incremental_lookup_reads_ids_then_pruned_dates(spark, workdir):
    paths, _ = _bronze(spark, workdir)
    job.run_transforms(spark, paths)
    current = job.read_silver(spark, paths.silver_dir)
    ids = current.limit(3).select("trip_id")
    lookup = _plan(silver.dates_holding(current, ids))
    reads = [line for line in lookup.splitlines() if line.startswith("ReadSchema")]
    assert reads and all("trip_id" in r and "fare_amount" not in r for r in reads)
    held = [r["pickup_date"] for r in silver.dates_holding(current, ids).collect()]
    copies = _plan(silver.stored_copies(current.where(F.col("pickup_date").isin(held)), ids))
    pruned = [line for line in copies.splitlines() if line.startswith("PartitionFilters")]
    assert pruned and "pickup_date" in pruned[0] and ("IN" in pruned[0] or " = " in pruned[0])


def test_ids_made_from_trips_are_looked_for_on_their_own_dates(spark, workdir):
    """No scan of stored ids: a content id holds the pickup time, so only its date can hold a copy."""
    paths, _ = _bronze(spark, workdir)
    job.run_transforms(spark, paths)
    current = job.read_silver(spark, paths.silver_dir)
    derived = current.limit(5).withColumn("trip_id", F.concat(F.lit("tlc_"), "trip_id"))
    days = {r.pickup_date for r in derived.collect()}
    before = job.silver.dates_holding
    job.silver.dates_holding = None   # not called
    try:
        assert set(job._dates_of_copies(current, derived)) == days
    finally:
        job.silver.dates_holding = before


def test_hot_null_id_is_split_in_the_incremental_semi_join(spark):
    """With the id list too large to broadcast, AQE splits the null id (a third of silver)."""
    g = generator.generate_trips(spark, date(2025, 1, 1), days=1, rows_per_day=30000, seed=9)
    s = g.withColumn("trip_id", F.when(F.col("passenger_count") <= 2, F.lit(None))
                                 .otherwise(F.col("trip_id")))
    s = silver.with_derived(s.withColumns({"ingested_at": F.col("pickup_datetime"),
                                           "source_batch_id": F.lit("b")}))
    ids = s.select("trip_id").distinct()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = silver.stored_copies(s, ids)
        assert len(df.collect()) == 30000
        assert "SortMergeJoin(skew=true)" in _plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_key_copies_count_duplicated_keys_like_a_grouped_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("c",), ("a",)], "trip_id string")
    checks = [quality.Expectation("dup", unique_key=("trip_id",)),
              quality.Expectation("dup_non_null", unique_key=("trip_id",), ignore_null_keys=True)]
    annotated = quality.with_key_copies(df, ["trip_id"])
    observed = annotated.agg(*quality.key_check_metrics(checks, ["trip_id"])).first().asDict()
    assert quality.observed_failures(observed) == {1: 2, 2: 1}
    grouped = {r.check_order: r.failures for r in quality.quality_report(df, checks).collect()}
    assert grouped == {1: 2, 2: 1}
