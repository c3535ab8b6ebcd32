"""Schemas and column lists of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical trip as produced by every source.
TRIP_SCHEMA = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("pickup_datetime", T.TimestampNTZType()),
    T.StructField("dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("pickup_zone_id", T.LongType()),
    T.StructField("dropoff_zone_id", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("payment_type", T.StringType()),
])
TRIP_COLUMNS = [f.name for f in TRIP_SCHEMA.fields]

# Bronze payload: trip plus provenance. ``ingested_at`` is ISO text ending in Z.
# Directory columns ``pickup_date`` and ``batch_key`` come from the layout.
BRONZE_PAYLOAD_SCHEMA = T.StructType(TRIP_SCHEMA.fields + [
    T.StructField("source_batch_id", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
])
BRONZE_SCHEMA = T.StructType(BRONZE_PAYLOAD_SCHEMA.fields + [
    T.StructField("pickup_date", T.DateType()),
    T.StructField("batch_key", T.StringType()),
])
BRONZE_PARTITION_COLUMNS = ["pickup_date", "batch_key"]

SILVER_SCHEMA = T.StructType(TRIP_SCHEMA.fields + [
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("source_batch_id", T.StringType()),
    T.StructField("pickup_date", T.DateType()),
    T.StructField("pickup_hour", T.LongType()),
    T.StructField("trip_duration_min", T.LongType()),
])
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

FACT_HOURLY_SCHEMA = T.StructType([
    T.StructField("pickup_date", T.DateType()),
    T.StructField("pickup_hour", T.LongType()),
    T.StructField("zone_id", T.LongType()),
    T.StructField("trip_count", T.LongType()),
    T.StructField("avg_trip_distance", T.DoubleType()),
    T.StructField("avg_fare_amount", T.DoubleType()),
    T.StructField("total_revenue", T.DoubleType()),
])
FACT_HOURLY_COLUMNS = [f.name for f in FACT_HOURLY_SCHEMA.fields]

DIM_ZONES_SCHEMA = T.StructType([
    T.StructField("zone_id", T.LongType()),
    T.StructField("zone_label", T.StringType()),
])

# Audit table, one row per run (newest row wins per run_id).
RUN_AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_reference", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("completed_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("data_start_date", T.DateType()),
    T.StructField("days", T.IntegerType()),
    T.StructField("rows_per_day", T.IntegerType()),
    T.StructField("seed", T.IntegerType()),
    T.StructField("bronze_rows", T.LongType()),
    T.StructField("bronze_files", T.LongType()),
    T.StructField("silver_rows", T.LongType()),
    T.StructField("gold_rows", T.LongType()),
    T.StructField("dim_zone_rows", T.LongType()),
    T.StructField("quality_passed", T.BooleanType()),
    T.StructField("checks_passed", T.IntegerType()),
    T.StructField("checks_failed", T.IntegerType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("summary_path", T.StringType()),
])
RUN_AUDIT_COLUMNS = [f.name for f in RUN_AUDIT_SCHEMA.fields]

# Dashboard projection of the audit table.
RUN_LIST_COLUMNS = ["run_id", "source_name", "status", "started_at", "duration_seconds",
                    "bronze_rows", "silver_rows", "gold_rows", "quality_passed"]

QUALITY_REPORT_SCHEMA = T.StructType([
    T.StructField("check_order", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("max_failures", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])
