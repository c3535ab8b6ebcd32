"""Trip-shaped views derived from the supplied ``events`` table.

The supplied test data has no trips, so trips, raw taxi records and audit rows
are derived row by row from ``events`` (see FIXTURES.md). Each view is a plain
projection of one scan: it keeps every row and grows with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def trips_from_events(events: DataFrame) -> DataFrame:
    """Canonical trips plus provenance (bronze content), one per event."""
    e, ts, v = F.col("event_id"), F.col("ts"), F.col("value")
    trip_no = F.when(e % 5 == 4, e - 1).otherwise(e)
    return events.select(
        F.concat(F.lit("trip_"), trip_no.cast("string")).alias("trip_id"),
        ts.alias("pickup_datetime"),
        F.when(e % 211 == 0, F.lit(None)).otherwise(_plus_seconds(ts, F.floor(v * 60.0)))
         .alias("dropoff_datetime"),
        F.when(e % 13 == 0, F.lit(None)).otherwise(e % 8).alias("passenger_count"),
        (v - 1.0).alias("trip_distance"),
        (F.col("user_id") % 50 + 1).alias("pickup_zone_id"),
        (e % 50 + 1).alias("dropoff_zone_id"),
        (v * 2.0 - 3.0).alias("fare_amount"),
        F.lit(0.0).alias("tip_amount"),
        F.when(e % 97 == 0, v).otherwise(v * 2.0 - 2.5).alias("total_amount"),
        F.when(F.col("event_type") == "view", "card")
         .when(F.col("event_type") == "click", "cash")
         .when(F.col("event_type") == "purchase", "app")
         .otherwise("unknown").alias("payment_type"),
        F.when(e % 7 == 0, F.lit(None)).otherwise(ts).alias("ingested_at"),
        F.when(e % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("batch_"), (e % 5).cast("string")))
         .alias("source_batch_id"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(table(spark, sf_dir, "events"))


def raw_taxi_from_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw yellow-layout taxi records with text times, junk and gaps.

    ``keep`` names columns of ``events`` carried along unchanged.
    """
    e, ts, v = F.col("event_id"), F.col("ts"), F.col("value")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return events.select(
        F.when(e % 4 == 0, F.lit(None)).otherwise(e % 2 + 1).alias("VendorID"),
        F.when(e % 101 == 0, F.lit("not a time")).otherwise(F.date_format(ts, fmt))
         .alias("tpep_pickup_datetime"),
        F.when(e % 211 == 0, F.lit(None))
         .otherwise(F.date_format(_plus_seconds(ts, F.floor(v * 60.0)), fmt))
         .alias("tpep_dropoff_datetime"),
        F.when(e % 13 == 0, F.lit("x")).otherwise((e % 8).cast("string")).alias("passenger_count"),
        F.when(e % 17 == 0, F.lit(None)).otherwise(v / 8.0).alias("trip_distance"),
        F.when(e % 19 == 0, F.lit(None)).otherwise((F.col("user_id") % 50 + 1).cast("double"))
         .alias("PULocationID"),
        (e % 50 + 1).cast("double").alias("DOLocationID"),
        (v * 2.0 - 3.0).alias("fare_amount"),
        F.when(e % 9 == 0, F.lit(None)).otherwise(v / 16.0).alias("tip_amount"),
        (v * 2.0 - 2.5).alias("total_amount"),
        F.when(e % 23 == 0, F.lit(None)).otherwise((e % 8).cast("double")).alias("payment_type"),
        *keep,
    )


def raw_taxi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_taxi_from_events(table(spark, sf_dir, "events"))


def runs_from_events(events: DataFrame) -> DataFrame:
    """Audit rows, several per run id (retries and re-runs)."""
    e = F.col("event_id")
    failed = F.col("event_type") == "error"
    return events.select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(e % 2 == 0, "synthetic").otherwise("taxi_yellow").alias("source_name"),
        F.when(failed, "failed").otherwise("succeeded").alias("status"),
        F.col("ts").alias("started_at"),
        F.col("value").alias("duration_seconds"),
        e.alias("bronze_rows"),
        F.when(failed, F.lit(None)).otherwise(e - e % 10).alias("silver_rows"),
        F.when(failed, F.lit(None)).otherwise(e % 1000).alias("gold_rows"),
        (F.col("event_type") != "error").alias("quality_passed"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_from_events(table(spark, sf_dir, "events"))
