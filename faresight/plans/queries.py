"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole supplied tables (or data Spark derives from them);
nothing is sampled, capped or sliced.
"""

from __future__ import annotations

import math
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.functions import columns
from faresight.operators import audit, gold, metrics, quality, silver
from faresight.plans import job
from faresight.plans import oracle as O
from faresight.plans.registry import register
from faresight.schemas import QUALITY_REPORT_SCHEMA, TRIP_COLUMNS
from faresight.session import apply_job_conf, fresh_path, read_text
from faresight.sources import bronze, fixtures, generator, taxi, tripdates
from faresight.streaming import ingest


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return silver.silver_trips(fixtures.trips(spark, sf_dir))


def _silver_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with the copies of each trip id counted where it is ranked: no other exchange."""
    return quality.with_key_copies(_silver(spark, sf_dir), ["trip_id"], silver.newest_first_order(
        silver.RECENCY_ORDER, silver.TIE_BREAK_ORDER))


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written once: what several results are made of is read, not built, again."""
    out = fresh_path(spark, "silver")
    built = _silver_with_copies(spark, sf_dir)
    built.write.parquet(out)
    return spark.read.schema(built.schema).parquet(out)


# --- minimum slice: silver and the hourly fact -----------------------------------------

@register("valid_trips", covers="P14 P15 P16",
          oracle=O.with_(O.TRIPS, O.silver_from("trips")) + "\nSELECT * FROM silver_valid")
def q_valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return silver.valid_trips(fixtures.trips(spark, sf_dir))


@register("silver_trips", covers="S5 P14-P18 W1 D1 D7 D8",
          oracle=O.with_(O.TRIPS, O.SILVER) + "\nSELECT * FROM silver")
def q_silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@register("fct_trip_hourly", covers="S5 A1 P20 D3",
          oracle=O.with_(O.TRIPS, O.SILVER) + O.fact_from("silver"))
def q_fct_trip_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_trip_hourly(_silver(spark, sf_dir))


@register("dim_zones", covers="S5 U1 P19 O1",
          oracle=O.with_(O.TRIPS, O.SILVER) + """
SELECT zone_id, 'Zone ' || CAST(zone_id AS VARCHAR) AS zone_label
FROM (SELECT pickup_zone_id AS zone_id FROM silver UNION SELECT dropoff_zone_id FROM silver)
ORDER BY zone_id""")
def q_dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_zones(_silver(spark, sf_dir))


@register("stg_trips", covers="S14",
          oracle=O.with_(O.TRIPS, O.SILVER) + f"\nSELECT {O.SILVER_COLS} FROM silver")
def q_stg_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging view, read by its name."""
    return spark.table(gold.create_staging_view(spark, _silver(spark, sf_dir)))


@register("fct_trip_hourly_stg", covers="A2",
          oracle=O.with_(O.TRIPS, O.SILVER, f"stg_trips AS (SELECT {O.SILVER_COLS} FROM silver)")
          + O.fact_from("stg_trips"))
def q_fct_trip_hourly_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_trip_hourly(gold.stg_trips(_silver(spark, sf_dir)))


# --- taxi source --------------------------------------------------------------------------

_TAXI_YEAR, _TAXI_MONTH = 2024, 1   # label of the monthly file written from events


@register("taxi_normalize", covers="P1-P7 D2 D4 D15",
          oracle=O.with_(O.RAW_TAXI)
          + O.normalize_sql("raw_taxi", "tpep_pickup_datetime", "tpep_dropoff_datetime"))
def q_taxi_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return taxi.normalize_taxi(fixtures.raw_taxi(spark, sf_dir), "yellow")


@register("taxi_read", covers="S1 S2 P1-P7",
          oracle=O.with_(O.RAW_TAXI)
          + O.normalize_sql("raw_taxi", "tpep_pickup_datetime", "tpep_dropoff_datetime"))
def q_taxi_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw records as a monthly yellow file, then locate and read it."""
    apply_job_conf(spark)
    root = fresh_path(spark, "taxi-yellow")
    path = taxi.monthly_path(root, "yellow", _TAXI_YEAR, _TAXI_MONTH)
    fixtures.raw_taxi(spark, sf_dir).write.mode("overwrite").parquet(path)
    trips, _ = taxi.load_taxi(spark, "yellow", year=_TAXI_YEAR, month=_TAXI_MONTH, root=root)
    return trips


@register("taxi_read_green_no_vendor", covers="S1 (no VendorID) P1 (green)",
          oracle=O.with_(O.RAW_TAXI)
          + O.normalize_sql("raw_taxi", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                            vendor=None))
def q_taxi_read_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green layout without a vendor column: the vendor reads as null."""
    apply_job_conf(spark)
    root = fresh_path(spark, "taxi-green")
    path = taxi.monthly_path(root, "green", _TAXI_YEAR, _TAXI_MONTH)
    raw = (fixtures.raw_taxi(spark, sf_dir).drop("VendorID")
           .withColumnsRenamed({"tpep_pickup_datetime": "lpep_pickup_datetime",
                                "tpep_dropoff_datetime": "lpep_dropoff_datetime"}))
    raw.write.mode("overwrite").parquet(path)
    trips, _ = taxi.load_taxi(spark, "green", source_path=path)
    return trips


# Four monthly files from one table: each third of January moves 0..3 months on, so every
# file holds its own month's trips. The months use three layouts: the full one (January and
# April, read together in one scan), no vendor column (February) and zones and payment
# codes stored as bigint (March).
_MONTHS = taxi.month_range((_TAXI_YEAR, 1), (_TAXI_YEAR, 4))
_RAW_MONTHS_SQL = """
raw_months AS (SELECT * REPLACE (CASE WHEN k = 1 THEN NULL ELSE VendorID END AS VendorID)
               FROM raw_m)"""
_MONTH_SHIFT_SQL = """
ev AS (
  SELECT * REPLACE (ts + to_months(k) AS ts)
  FROM (SELECT *, CASE WHEN day(ts) <= 7 THEN 0 WHEN day(ts) <= 14 THEN 1
                       WHEN day(ts) <= 21 THEN 2 ELSE 3 END AS k FROM events))"""


def _month_shift(events: DataFrame) -> DataFrame:
    day = F.dayofmonth("ts")
    k = (F.when(day <= 7, 0).when(day <= 14, 1).when(day <= 21, 2).otherwise(3))
    return (events.withColumn("k", k)
                  .withColumn("ts", F.col("ts") + F.make_ym_interval(F.lit(0), F.col("k"))))


def _month_layout(raw: DataFrame, k: int) -> DataFrame:
    if k == 1:
        return raw.drop("VendorID")
    if k == 2:
        return raw.withColumns({c: F.col(c).cast("long")
                                for c in ("PULocationID", "DOLocationID", "payment_type")})
    return raw


def _write_months(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """One raw yellow file per month under ``root`` (layouts differ by month); their paths."""
    raw = fixtures.raw_taxi_from_events(_month_shift(fixtures.table(spark, sf_dir, "events")),
                                        keep=["k"])
    paths = []
    for k, (year, month) in enumerate(_MONTHS):
        paths.append(taxi.monthly_path(root, "yellow", year, month))
        _month_layout(raw.where(F.col("k") == k).drop("k"), k).write.mode("overwrite").parquet(paths[-1])
    return paths


@register("taxi_read_months", covers="S1 S2 (a range of months, grouped by file layout) D15",
          oracle=O.with_(_MONTH_SHIFT_SQL, O.raw_taxi_sql("ev", "raw_m", ", k"), _RAW_MONTHS_SQL)
          + O.normalize_sql("raw_months", "tpep_pickup_datetime", "tpep_dropoff_datetime"))
def q_taxi_read_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one file per month (layouts differ by month), then read the month range."""
    apply_job_conf(spark)
    root = fresh_path(spark, "taxi-months")
    _write_months(spark, sf_dir, root)
    trips, _ = taxi.load_taxi(spark, "yellow", months=_MONTHS, root=root)
    return trips


@register("taxi_read_folder", covers="S1 S2 (a folder and a pattern of files of several layouts)",
          oracle=O.with_(_MONTH_SHIFT_SQL, O.raw_taxi_sql("ev", "raw_m", ", k"), _RAW_MONTHS_SQL,
                         "taxi AS (" + O.normalize_sql("raw_months", "tpep_pickup_datetime",
                                                       "tpep_dropoff_datetime") + ")")
          + "\nSELECT 'folder' AS given, * FROM taxi UNION ALL SELECT 'pattern', * FROM taxi")
def q_taxi_read_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly files (one without vendor, one with bigint codes) by their folder, and by a pattern."""
    apply_job_conf(spark)
    root = fresh_path(spark, "taxi-folder")
    _write_months(spark, sf_dir, root)
    folder, _ = taxi.load_taxi(spark, "yellow", source_path=root)
    pattern, _ = taxi.load_taxi(spark, "yellow", source_path=f"{root}/yellow_tripdata_*.parquet")
    return (folder.select(F.lit("folder").alias("given"), "*")
            .unionByName(pattern.select(F.lit("pattern").alias("given"), "*")))


@register("taxi_read_kept_layouts", covers="S1 S2 (layouts kept by file: two months, then all four)",
          oracle=O.with_(_MONTH_SHIFT_SQL, O.raw_taxi_sql("ev", "raw_m", ", k"), _RAW_MONTHS_SQL)
          + O.normalize_sql("raw_months", "tpep_pickup_datetime", "tpep_dropoff_datetime"))
def q_taxi_read_kept_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months read with their layouts kept, then all: only the new files' footers are read."""
    apply_job_conf(spark)
    root, kept = fresh_path(spark, "taxi-kept"), fresh_path(spark, "taxi-layouts")
    _write_months(spark, sf_dir, root)
    taxi.load_taxi(spark, "yellow", months=_MONTHS[:2], root=root, layouts=kept)
    trips, _ = taxi.load_taxi(spark, "yellow", months=_MONTHS, root=root, layouts=kept)
    return trips


# --- bronze -------------------------------------------------------------------------------

_BRONZE_COLS = O.TRIP_COLS + ", source_batch_id, ingested_at, pickup_date, batch_key"
_RT_BATCH, _RT_TIME = "roundtrip-1", datetime(2024, 2, 1, tzinfo=UTC)


@register("bronze_roundtrip", covers="S3 S4 P10 P12",
          oracle=O.with_(O.TRIPS) + f"""
SELECT {O.TRIP_COLS}, '{_RT_BATCH}' AS source_batch_id, '2024-02-01T00:00:00Z' AS ingested_at,
       CAST(pickup_datetime AS DATE) AS pickup_date, '{_RT_BATCH}' AS batch_key
FROM trips""")
def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    out = fresh_path(spark, "bronze")
    bronze.write_bronze(fixtures.trips(spark, sf_dir).select(*TRIP_COLUMNS), out,
                        batch_id=_RT_BATCH, ingested_at=_RT_TIME, source_name="synthetic")
    return bronze.scan_bronze(spark, out).select(*_BRONZE_COLS.split(", "))


_REPLAY_BATCH = "replay/1"
_REPLAY_T1, _REPLAY_T2 = datetime(2024, 2, 1, tzinfo=UTC), datetime(2024, 2, 2, 6, 30, tzinfo=UTC)
_REPLAY_LAST_DAY = 15


@register("bronze_replay_idempotent", covers="S4 D13 D14",
          oracle=O.with_(O.TRIPS) + f"""
SELECT trip_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
       pickup_zone_id, dropoff_zone_id,
       CASE WHEN second_run THEN fare_amount + 1.0 ELSE fare_amount END AS fare_amount,
       tip_amount, total_amount, payment_type,
       '{_REPLAY_BATCH}' AS source_batch_id,
       CASE WHEN second_run THEN '2024-02-02T06:30:00Z' ELSE '2024-02-01T00:00:00Z' END AS ingested_at,
       CAST(pickup_datetime AS DATE) AS pickup_date,
       {O.batch_key_sql(f"'{_REPLAY_BATCH}'")} AS batch_key
FROM (SELECT *, day(pickup_datetime) <= {_REPLAY_LAST_DAY} AS second_run FROM trips)""")
def q_bronze_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run a batch twice; the re-run (corrected fares, first half of the month)
    replaces only the dates it writes, twice in a row gives the same result."""
    apply_job_conf(spark)
    out = fresh_path(spark, "bronze-replay")
    trips = fixtures.trips(spark, sf_dir).select(*TRIP_COLUMNS)
    bronze.write_bronze(trips, out, batch_id=_REPLAY_BATCH, ingested_at=_REPLAY_T1)
    rerun = (trips.where(F.dayofmonth("pickup_datetime") <= _REPLAY_LAST_DAY)
                  .withColumn("fare_amount", F.col("fare_amount") + 1.0))
    for _ in range(2):
        bronze.write_bronze(rerun, out, batch_id=_REPLAY_BATCH, ingested_at=_REPLAY_T2)
    return bronze.scan_bronze(spark, out).select(*_BRONZE_COLS.split(", "))


def _layout_roots(spark: SparkSession, sf_dir: str) -> list[str]:
    """Bronze history in two layouts: rows without a batch in the legacy layout
    (no provenance, narrower types), all others in the current layout."""
    trips = fixtures.trips(spark, sf_dir)
    legacy_root, current_root = fresh_path(spark, "bronze-legacy"), fresh_path(spark, "bronze-current")
    (bronze.legacy_payload(trips.where(F.col("source_batch_id").isNull()))
        .write.mode("overwrite").partitionBy("pickup_date").parquet(legacy_root))
    bronze.write_bronze(trips.where(F.col("source_batch_id").isNotNull()), current_root)
    return [legacy_root, current_root]


@register("bronze_scan_merge", covers="S3 U2 D6 S9",
          oracle=O.with_(O.TRIPS) + f"""
SELECT {O.TRIP_COLS}, source_batch_id,
       CASE WHEN source_batch_id IS NULL OR ingested_at IS NULL THEN NULL
            ELSE {O.iso_sql('ingested_at')} END AS ingested_at,
       CAST(pickup_datetime AS DATE) AS pickup_date,
       {O.batch_key_sql('source_batch_id')} AS batch_key
FROM trips""")
def q_bronze_scan_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return bronze.scan_bronze_layouts(spark, _layout_roots(spark, sf_dir)).select(
        *_BRONZE_COLS.split(", "))


@register("silver_from_bronze_layouts", covers="S3 U2 P15 W1 over mixed bronze",
          oracle=O.with_(O.TRIPS, """
merged AS (
  SELECT * REPLACE (CASE WHEN source_batch_id IS NULL THEN NULL ELSE ingested_at END AS ingested_at)
  FROM trips)""", O.silver_from("merged")) + "\nSELECT * FROM silver")
def q_silver_from_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    merged = bronze.scan_bronze_layouts(spark, _layout_roots(spark, sf_dir))
    return silver.silver_trips(merged)


@register("batch_key", covers="P11 D14",
          oracle=f"""
SELECT batch_id, {O.batch_key_sql('batch_id')} AS batch_key,
       count(*) OVER (PARTITION BY {O.batch_key_sql('batch_id')}) AS ids_of_key
FROM (SELECT DISTINCT CASE event_id % 8
        WHEN 0 THEN event_type || '/' || CAST(user_id AS VARCHAR) WHEN 1 THEN event_type || ' ' || CAST(user_id AS VARCHAR)
        WHEN 2 THEN event_type || '_' || CAST(user_id AS VARCHAR) WHEN 3 THEN event_type || 'é' || CAST(user_id AS VARCHAR)
        WHEN 4 THEN '00' || CAST(user_id AS VARCHAR) WHEN 5 THEN event_type || '~2F' || CAST(user_id AS VARCHAR)
        WHEN 6 THEN event_type || '=%+*.:' || CAST(user_id AS VARCHAR)
        ELSE event_type || '_' || CAST(user_id AS VARCHAR) || '-' || substr(md5(event_type || '/' || CAST(user_id AS VARCHAR)), 1, 8)
      END AS batch_id FROM events)""")
def q_batch_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that differ in reserved characters only, that look like other ids' keys, or like numbers."""
    ev = fixtures.table(spark, sf_dir, "events")
    kind, text, user = F.col("event_id") % 8, F.col("event_type"), F.col("user_id").cast("string")
    slashed = F.concat(text, F.lit("/"), user)
    ids = (F.when(kind == 0, slashed).when(kind == 1, F.concat(text, F.lit(" "), user))
            .when(kind == 2, F.concat(text, F.lit("_"), user)).when(kind == 3, F.concat(text, F.lit("é"), user))
            .when(kind == 4, F.concat(F.lit("00"), user)).when(kind == 5, F.concat(text, F.lit("~2F"), user))
            .when(kind == 6, F.concat(text, F.lit("=%+*.:"), user))
            .otherwise(F.concat(text, F.lit("_"), user, F.lit("-"), F.substring(F.md5(slashed), 1, 8))))
    keyed = ev.select(ids.alias("batch_id")).distinct().select("batch_id", columns.batch_key("batch_id").alias("batch_key"))
    return keyed.withColumn("ids_of_key", F.count(F.lit(1)).over(Window.partitionBy("batch_key")))


# --- quality ------------------------------------------------------------------------------

@register("quality_report", covers="Q1-Q9 A4 A5",
          oracle=O.with_(O.TRIPS, O.SILVER) + "\n" + O.report_sql("silver", O.SILVER_CHECKS_SQL))
def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report_in_one_pass(_silver_with_copies(spark, sf_dir), quality.silver_expectations(), ["trip_id"])


@register("quality_report_stored", covers="S7 Q9: the report written as JSON and read back",
          oracle=O.with_(O.TRIPS, O.SILVER) + "\n" + O.report_sql("silver", O.SILVER_CHECKS_SQL))
def q_quality_report_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "quality-report")
    quality.evaluate(q_quality_report(spark, sf_dir), out, raise_on_failure=False)
    return spark.read.schema(QUALITY_REPORT_SCHEMA).json(out)


def _derived(df: DataFrame) -> DataFrame:
    return silver.with_derived(silver.typed_trips(df))


@register("quality_on_bronze", covers="Q1-Q9 on unfiltered trips and normalized raw taxi",
          oracle=O.with_(O.TRIPS, O.RAW_TAXI, O.derived_sql("trips", "trips_d"),
                         "taxi AS (" + O.normalize_sql("raw_taxi", "tpep_pickup_datetime",
                                                       "tpep_dropoff_datetime") + ")",
                         O.derived_sql("taxi", "taxi_d", provenance=False))
          + "\n" + O.report_sql("trips_d", O.SILVER_CHECKS_SQL, "'trips' AS dataset, ")
          + "\nUNION ALL\n" + O.report_sql("taxi_d", O.SILVER_CHECKS_SQL, "'raw_taxi' AS dataset, "))
def q_quality_on_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    checks = quality.silver_expectations()
    trips_r = quality.quality_report(_derived(fixtures.trips(spark, sf_dir)), checks)
    taxi_r = quality.quality_report(
        _derived(taxi.normalize_taxi(fixtures.raw_taxi(spark, sf_dir), "yellow")), checks)
    return (trips_r.select(F.lit("trips").alias("dataset"), "*")
            .unionByName(taxi_r.select(F.lit("raw_taxi").alias("dataset"), "*")))


@register("quality_summary", covers="A8 Q9",
          oracle=O.with_(O.TRIPS, O.SILVER,
                         "report AS (" + O.report_sql("silver", O.SILVER_CHECKS_SQL) + ")") + """
SELECT CAST(count_if(passed) AS INTEGER) AS checks_passed,
       CAST(count_if(NOT passed) AS INTEGER) AS checks_failed,
       coalesce(bool_and(passed), true) AS overall_pass
FROM report""")
def q_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(q_quality_report(spark, sf_dir))


_STG_NOT_NULL = ["trip_id", "pickup_datetime", "dropoff_datetime", "ingested_at", "source_batch_id"]
_FACT_NOT_NULL = ["pickup_date", "pickup_hour"]


@register("column_tests", covers="Q11 Q12",
          oracle=O.with_(O.TRIPS, O.SILVER, O.FACT_CTE) + "\n"
          + O.report_sql("silver", [(f"not_null_{c}", f"{c} IS NULL") for c in _STG_NOT_NULL]
                         + [("unique_trip_id", None)], "'stg_trips' AS model, ",
                         unique_ignore_null=True)
          + "\nUNION ALL\n"
          + O.report_sql("fact", [(f"not_null_{c}", f"{c} IS NULL") for c in _FACT_NOT_NULL],
                         "'fct_trip_hourly' AS model, "))
def q_column_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = _stored_silver(spark, sf_dir)
    fact = gold.fct_trip_hourly(gold.stg_trips(stg))
    stg_r = quality.report_in_one_pass(stg, quality.not_null_tests(_STG_NOT_NULL)
                                       + [quality.unique_test(["trip_id"])], ["trip_id"])
    fact_r = quality.quality_report(fact, quality.not_null_tests(_FACT_NOT_NULL))
    return (stg_r.select(F.lit("stg_trips").alias("model"), "*")
            .unionByName(fact_r.select(F.lit("fct_trip_hourly").alias("model"), "*")))


@register("duplicate_keys", covers="A5 Q6 Q12",
          oracle=O.with_(O.TRIPS, O.SILVER) + f"""
SELECT 'lineitem' AS dataset, 'l_orderkey,l_linenumber' AS key_columns,
       {O.dup_count_sql('lineitem', 'l_orderkey, l_linenumber')} AS duplicate_keys
UNION ALL
SELECT 'trips', 'trip_id', {O.dup_count_sql('trips', 'trip_id')}
UNION ALL
SELECT 'silver', 'trip_id', {O.dup_count_sql('silver', 'trip_id')}""")
def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = fixtures.table(spark, sf_dir, "lineitem")
    sets = [("lineitem", lineitem, ["l_orderkey", "l_linenumber"]),
            ("trips", fixtures.trips(spark, sf_dir), ["trip_id"]),
            ("silver", _silver(spark, sf_dir), ["trip_id"])]
    parts = [quality.duplicate_key_count(df, keys).select(
                F.lit(name).alias("dataset"), F.lit(",".join(keys)).alias("key_columns"),
                F.col("failures").alias("duplicate_keys"))
             for name, df, keys in sets]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]


@register("latest_per_key", covers="W1 on lineitem",
          oracle="""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """
          + ", ".join(f"{c} DESC NULLS LAST" for c in ["l_shipdate"] + [
              c for c in _LINEITEM_COLS if c not in ("l_shipdate", "l_orderkey", "l_linenumber")])
          + """) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = fixtures.table(spark, sf_dir, "lineitem")
    rest = [c for c in _LINEITEM_COLS if c not in ("l_shipdate", "l_orderkey", "l_linenumber")]
    return silver.latest_per_key(lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"], rest)


# --- audit --------------------------------------------------------------------------------

@register("batch_ingest_stats", covers="S15 A6 A9 R5 D9",
          oracle=O.with_(O.TRIPS, O.RAW_TAXI, "taxi AS (" + O.normalize_sql(
              "raw_taxi", "tpep_pickup_datetime", "tpep_dropoff_datetime") + ")") + """
SELECT source_batch_id, count(*) AS rows, count(DISTINCT pickup_date) AS partitions,
       min(pickup_date) AS min_pickup_date
FROM (SELECT source_batch_id, CAST(pickup_datetime AS DATE) AS pickup_date FROM trips
      UNION ALL
      SELECT 'taxi-2024-01', CAST(pickup_datetime AS DATE) FROM taxi WHERE pickup_datetime IS NOT NULL)
GROUP BY source_batch_id""")
def q_batch_ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay of the trip batches plus one taxi batch (with unparseable pickups,
    which are rejected) into one bronze, then statistics per batch."""
    apply_job_conf(spark)
    out = fresh_path(spark, "bronze-stats")
    bronze.write_bronze(fixtures.trips(spark, sf_dir), out)
    trips = taxi.normalize_taxi(fixtures.raw_taxi(spark, sf_dir), "yellow")
    bronze.write_bronze(trips, out, batch_id="taxi-2024-01", ingested_at=_RT_TIME,
                        source_name=taxi.source_name("yellow"))
    return audit.batch_ingest_stats(bronze.scan_bronze(spark, out))


@register("batch_lineage", covers="A13",
          oracle=O.with_(O.TRIPS, O.SILVER) + """,
b AS (SELECT source_batch_id, count(*) AS bronze_rows FROM silver_typed GROUP BY 1),
v AS (SELECT source_batch_id, count(*) AS valid_rows FROM silver_valid GROUP BY 1),
s AS (SELECT source_batch_id, count(*) AS silver_rows FROM silver GROUP BY 1)
SELECT b.source_batch_id, bronze_rows, coalesce(valid_rows, 0) AS valid_rows,
       coalesce(silver_rows, 0) AS silver_rows,
       bronze_rows - coalesce(valid_rows, 0) AS rejected_rows,
       coalesce(valid_rows, 0) - coalesce(silver_rows, 0) AS superseded_rows
FROM b LEFT JOIN v USING (source_batch_id) LEFT JOIN s USING (source_batch_id)""")
def q_batch_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return audit.batch_lineage(fixtures.trips(spark, sf_dir))


@register("layer_counts", covers="A3 A12",
          oracle=O.with_(O.TRIPS, O.SILVER, O.FACT_CTE) + """
SELECT 'silver_trips' AS layer, count(*) AS rows FROM silver
UNION ALL SELECT 'fct_trip_hourly', count(*) FROM fact
UNION ALL SELECT 'dim_zones', count(*) FROM (SELECT pickup_zone_id FROM silver UNION SELECT dropoff_zone_id FROM silver)""")
def q_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _stored_silver(spark, sf_dir)
    return audit.layer_counts([("silver_trips", s), ("fct_trip_hourly", gold.fct_trip_hourly(s)),
                               ("dim_zones", gold.dim_zones(s, ordered=False))])


@register("distinct_batches", covers="A10",
          oracle=O.with_(O.TRIPS, O.SILVER)
          + "\nSELECT count(DISTINCT source_batch_id) AS distinct_batches FROM silver")
def q_distinct_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_batches(_silver(spark, sf_dir))


@register("trip_lookup", covers="A11",
          oracle=O.with_(O.TRIPS, O.SILVER) + """
SELECT trip_id, count(*) AS copies, max(source_batch_id) AS max_source_batch_id,
       max(fare_amount) AS max_fare_amount
FROM silver WHERE trip_id IN (SELECT trip_id FROM trips GROUP BY trip_id HAVING count(*) > 1)
GROUP BY trip_id""")
def q_trip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up, in silver, every trip that arrived in more than one copy."""
    trips = fixtures.trips(spark, sf_dir)
    repeated = trips.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return audit.trip_lookup(_silver(spark, sf_dir), repeated)


_RUN_LIST = ("run_id, source_name, status, started_at, duration_seconds, bronze_rows, silver_rows, "
             "gold_rows, quality_passed")
_RUNS_LATEST_SQL = O.with_(O.RUNS) + f"""
, latest AS (
  SELECT {_RUN_LIST} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id
              ORDER BY started_at DESC NULLS LAST, bronze_rows DESC NULLS LAST) AS rn
    FROM runs) WHERE rn = 1)"""


def _stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows appended to a run table with the full (evolved) schema, read back."""
    audit_dir = fresh_path(spark, "run-audit")
    fixtures.runs(spark, sf_dir).write.mode("append").parquet(audit_dir)
    return audit.read_runs(spark, audit_dir)


@register("run_audit_latest", covers="W2 S9 S10 P22",
          oracle=_RUNS_LATEST_SQL + "\nSELECT * FROM latest")
def q_run_audit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest_runs(_stored_runs(spark, sf_dir)).select(*_RUN_LIST.split(", "))


@register("run_audit_replaced", covers="S10: a later row of a run id replaces the stored one",
          oracle=O.with_(O.RUNS) + f"""
, again AS (SELECT * REPLACE (started_at + INTERVAL 1 YEAR AS started_at, 'retried' AS status)
            FROM runs WHERE bronze_rows % 3 = 0)
SELECT {_RUN_LIST} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id
            ORDER BY started_at DESC NULLS LAST, bronze_rows DESC NULLS LAST) AS rn
  FROM (SELECT * FROM runs UNION ALL SELECT * FROM again)) WHERE rn = 1""")
def q_run_audit_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit_dir, runs = fresh_path(spark, "run-audit"), fixtures.runs(spark, sf_dir)
    runs.write.mode("append").parquet(audit_dir)
    again = (runs.where(F.col("bronze_rows") % 3 == 0).withColumn("status", F.lit("retried"))
             .withColumn("started_at", F.col("started_at") + F.make_ym_interval(F.lit(1))))
    again.write.mode("append").parquet(audit_dir)
    return audit.latest_runs(audit.read_runs(spark, audit_dir)).select(*_RUN_LIST.split(", "))


_RUNS_AGAIN_SQL = O.with_(O.RUNS) + f"""
, again AS (SELECT * REPLACE (started_at + INTERVAL 1 YEAR AS started_at, 'retried' AS status)
            FROM runs WHERE bronze_rows % 3 = 0)
, newest AS (
  SELECT {_RUN_LIST} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id
              ORDER BY started_at DESC NULLS LAST, bronze_rows DESC NULLS LAST) AS rn
    FROM (SELECT * FROM runs UNION ALL SELECT * FROM again)) WHERE rn = 1)"""


def _merged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows appended, merged, replaced in part, merged again, and one replacement left beside the base."""
    audit_dir, runs = fresh_path(spark, "run-merged"), fixtures.runs(spark, sf_dir)
    again = (runs.where(F.col("bronze_rows") % 3 == 0).withColumn("status", F.lit("retried"))
             .withColumn("started_at", F.col("started_at") + F.make_ym_interval(F.lit(1))))
    late = F.col("bronze_rows") % 2 == 0
    runs.write.mode("append").parquet(audit_dir)
    audit.merge_runs(spark, audit_dir, least=1)
    again.where(~late).write.mode("append").parquet(audit_dir)
    audit.merge_runs(spark, audit_dir, least=1)
    again.where(late).write.mode("append").parquet(audit_dir)
    return audit.read_runs(spark, audit_dir)


@register("run_audit_merged", covers="S10 W2 (appended files merged into a base sorted by run id)",
          oracle=_RUNS_AGAIN_SQL + "\nSELECT * FROM newest")
def q_run_audit_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest_runs(_merged_runs(spark, sf_dir)).select(*_RUN_LIST.split(", "))


@register("run_lookup_merged", covers="O4 (one run, looked up by its id in base and appended rows)",
          oracle=_RUNS_AGAIN_SQL + "\nSELECT * FROM newest WHERE run_id = (SELECT MAX(run_id) FROM runs)")
def q_run_lookup_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _merged_runs(spark, sf_dir)
    last = runs.agg(F.max("run_id")).first()[0]
    return audit.run_of(runs, last).select(*_RUN_LIST.split(", "))


@register("run_recent", covers="O3 O6 P22",
          oracle=_RUNS_LATEST_SQL + f"""
SELECT {_RUN_LIST} FROM latest
ORDER BY started_at DESC NULLS LAST, bronze_rows DESC NULLS LAST, run_id DESC LIMIT 10""")
def q_run_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.recent_runs(_stored_runs(spark, sf_dir), 10).select(*_RUN_LIST.split(", "))


@register("run_latest", covers="O4",
          oracle=_RUNS_LATEST_SQL + f"""
SELECT {_RUN_LIST} FROM latest
ORDER BY started_at DESC NULLS LAST, bronze_rows DESC NULLS LAST, run_id DESC LIMIT 1""")
def q_run_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.recent_runs(_stored_runs(spark, sf_dir), 1).select(*_RUN_LIST.split(", "))


# --- dashboard ----------------------------------------------------------------------------

_SERIES_SQL = O.with_(O.TRIPS, O.SILVER, O.FACT_CTE) + """
SELECT CAST(pickup_date AS TIMESTAMP) AS pickup_date, pickup_hour, zone_id, trip_count,
       avg_trip_distance, avg_fare_amount, total_revenue
FROM fact ORDER BY pickup_date, pickup_hour, zone_id"""


@register("hourly_series", covers="S11 P21 O2", oracle=_SERIES_SQL)
def q_hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.hourly_series(gold.fct_trip_hourly(_silver(spark, sf_dir)))


@register("hourly_head", covers="O5 O6", oracle=_SERIES_SQL + " LIMIT 50")
def q_hourly_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.hourly_head(gold.fct_trip_hourly(_silver(spark, sf_dir)), 50)


@register("dashboard_kpis", covers="A7 D12",
          oracle=O.with_(O.TRIPS, O.SILVER, O.FACT_CTE) + O.kpis_from("fact"))
def q_dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dashboard_kpis(gold.fct_trip_hourly(_silver(spark, sf_dir)))


# Amounts that whole cents and doubles get wrong, by pickup zone: parts of a cent, amounts
# beyond the exact decimals (a power of two, so that double sums are exact), NaN, infinity.
_HUGE = 2.0 ** 70
_EXTREMES_SQL = f"""
extremes AS (
  SELECT * REPLACE (
    CASE pickup_zone_id % 5 WHEN 1 THEN total_amount / 1000 WHEN 2 THEN {_HUGE!r}
         WHEN 3 THEN CASE WHEN hour(pickup_datetime) % 3 = 0 THEN 'nan'::DOUBLE ELSE total_amount END
         WHEN 4 THEN CASE WHEN hour(pickup_datetime) % 3 = 0 THEN 'inf'::DOUBLE ELSE total_amount END
         ELSE total_amount END AS total_amount,
    CASE pickup_zone_id % 5 WHEN 1 THEN fare_amount / 1000 WHEN 2 THEN {_HUGE!r}
         WHEN 3 THEN CASE WHEN hour(pickup_datetime) % 3 = 0 THEN 'nan'::DOUBLE ELSE fare_amount END
         ELSE fare_amount END AS fare_amount)
  FROM silver)"""


def _extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_extremes(_silver(spark, sf_dir))


def _with_extremes(trips: DataFrame) -> DataFrame:
    kind = F.col("pickup_zone_id") % 5
    third = F.hour("pickup_datetime") % 3 == 0

    def changed(name: str, odd: list[tuple[int, float]]) -> Column:
        out = F.when(kind == 1, F.col(name) / 1000.0).when(kind == 2, F.lit(_HUGE))
        for k, value in odd:
            out = out.when((kind == k) & third, F.lit(value))
        return out.otherwise(F.col(name))
    return trips.withColumns({"total_amount": changed("total_amount", [(3, math.nan), (4, math.inf)]),
                              "fare_amount": changed("fare_amount", [(3, math.nan)])})


@register("fct_trip_hourly_extremes", covers="A1 D3 with sub-cent, huge, NaN and infinite amounts",
          oracle=O.with_(O.TRIPS, O.SILVER, _EXTREMES_SQL) + O.fact_from("extremes"))
def q_fct_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_trip_hourly(_extremes(spark, sf_dir))


@register("dashboard_kpis_extremes", covers="A7 D12 with huge, NaN and infinite groups",
          oracle=O.with_(O.TRIPS, O.SILVER, _EXTREMES_SQL, f"fact AS ({O.fact_from('extremes')})") + O.huge_kpis_from("fact"))
def q_kpis_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dashboard_kpis(gold.fct_trip_hourly(_extremes(spark, sf_dir)))


# Amounts of very different sizes, none of them a power of two: their double sums depend on the order of rows.
_SCALES = {1: 1e6, 2: 1e18, 3: 1e21, 4: -1e19}
_HUGE_SQL = """
huge AS (
  SELECT * REPLACE (total_amount * scale AS total_amount, fare_amount * scale AS fare_amount)
  FROM (SELECT *, CASE passenger_count %s ELSE 1e0 END AS scale FROM silver))""" % " ".join(
    f"WHEN {k} THEN {v!r}" for k, v in _SCALES.items())


def _huge(spark: SparkSession, sf_dir: str) -> DataFrame:
    scale = F.lit(1.0)
    for k, v in _SCALES.items():
        scale = F.when(F.col("passenger_count") == k, F.lit(v)).otherwise(scale)
    return _silver(spark, sf_dir).withColumns({c: F.col(c) * scale for c in ("total_amount", "fare_amount")})


@register("fct_trip_hourly_huge", covers="A1 D3: amounts up to 10^23 and of both signs in one group",
          oracle=O.with_(O.TRIPS, O.SILVER, _HUGE_SQL) + O.huge_fact_from("huge"))
def q_fct_huge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_trip_hourly(_huge(spark, sf_dir))


@register("dashboard_kpis_huge", covers="A7 D12: totals of the same amounts, exact whatever the order",
          oracle=O.with_(O.TRIPS, O.SILVER, _HUGE_SQL, f"fact AS ({O.huge_fact_from('huge')})") + O.huge_kpis_from("fact"))
def q_kpis_huge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dashboard_kpis(gold.fct_trip_hourly(_huge(spark, sf_dir)))


# --- generator, whole job, export ---------------------------------------------------------

_GEN_START, _GEN_PER_DAY, _GEN_SEED = date(2024, 1, 1), 1000, 42


@register("generated_trips", covers="S13 P13",
          oracle=O.with_("g_ids AS (SELECT event_id AS id FROM events)",
                         O.generated_trips_sql("g_ids", _GEN_START.isoformat(), _GEN_PER_DAY,
                                               _GEN_SEED)))
def q_generated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic trip per event id (1,000 per day from 2024-01-01, seed 42)."""
    ids = fixtures.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return generator.trips_for_ids(ids, _GEN_START, rows_per_day=_GEN_PER_DAY, seed=_GEN_SEED)


_JOB_RUN = "job-taxi-2024-01"
_JOB_SQL = O.with_(
    O.RAW_TAXI,
    "taxi AS (" + O.normalize_sql("raw_taxi", "tpep_pickup_datetime", "tpep_dropoff_datetime") + ")",
    f"""
b AS (SELECT *, '{_JOB_RUN}' AS source_batch_id, TIMESTAMP '2000-01-01' AS ingested_at
      FROM taxi WHERE pickup_datetime IS NOT NULL)""",
    O.silver_from("b"), O.FACT_CTE,
    "report AS (" + O.report_sql("silver", O.SILVER_CHECKS_SQL) + ")") + f"""
SELECT '{_JOB_RUN}' AS run_id, 'taxi_yellow' AS source_name,
       CASE WHEN (SELECT bool_and(passed) FROM report) THEN 'succeeded' ELSE 'failed' END AS status,
       (SELECT min(CAST(pickup_datetime AS DATE)) FROM b) AS data_start_date,
       (SELECT count(*) FROM b) AS bronze_rows,
       (SELECT count(DISTINCT CAST(pickup_datetime AS DATE)) FROM b) AS bronze_files,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM fact) AS gold_rows,
       (SELECT count(*) FROM (SELECT pickup_zone_id FROM silver UNION SELECT dropoff_zone_id FROM silver))
         AS dim_zone_rows,
       (SELECT bool_and(passed) FROM report) AS quality_passed,
       (SELECT CAST(count_if(passed) AS INTEGER) FROM report) AS checks_passed,
       (SELECT CAST(count_if(NOT passed) AS INTEGER) FROM report) AS checks_failed,
       CASE WHEN (SELECT bool_and(passed) FROM report) THEN NULL ELSE 'Quality checks failed' END
         AS error_message"""

_JOB_COLS = ["run_id", "source_name", "status", "data_start_date", "bronze_rows", "bronze_files",
             "silver_rows", "gold_rows", "dim_zone_rows", "quality_passed", "checks_passed",
             "checks_failed", "error_message"]


@register("medallion_job", covers="R1 R2 R3 R4 R5 R6 S5 S8 S10 D9 D10 D11", oracle=_JOB_SQL)
def q_medallion_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole job on a monthly taxi file written from the raw records; the audit row
    it stored (quality fails on zero-passenger trips, so the run is 'failed')."""
    apply_job_conf(spark)
    taxi_root = fresh_path(spark, "taxi-landing")
    fixtures.raw_taxi(spark, sf_dir).write.mode("overwrite").parquet(
        taxi.monthly_path(taxi_root, "yellow", _TAXI_YEAR, _TAXI_MONTH))
    root = fresh_path(spark, "warehouse")
    job.run_job(spark, root, run_id=_JOB_RUN, source="taxi", dataset="yellow", year=_TAXI_YEAR,
                month=_TAXI_MONTH, taxi_root=taxi_root, raise_on_failure=False)
    runs = audit.latest_runs(audit.read_runs(spark, job.resolve_paths(root).runs_dir))
    return runs.where(F.col("run_id") == _JOB_RUN).select(*_JOB_COLS)


@register("export_roundtrip", covers="S5 S6 R2",
          oracle=O.with_(O.TRIPS, O.SILVER) + O.fact_from("silver"))
def q_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze replay of all trip batches -> transforms -> the fact as read back from parquet."""
    apply_job_conf(spark)
    paths = job.resolve_paths(fresh_path(spark, "warehouse"))
    bronze.write_bronze(fixtures.trips(spark, sf_dir), paths.bronze_dir)
    job.run_transforms(spark, paths)
    return job.read_fact(spark, paths.fact_dir)


# --- scalar functions ---------------------------------------------------------------------

@register("scalar_time", covers="D1 CAST AS DATE, EXTRACT hour, DATE_DIFF minute",
          oracle="""
SELECT event_id, ts AS pickup_datetime, d AS dropoff_datetime,
       CAST(ts AS DATE) AS pickup_date, EXTRACT('hour' FROM ts) AS pickup_hour,
       DATE_DIFF('minute', ts, d) AS duration_min, DATE_DIFF('minute', d, ts) AS reverse_min
FROM (SELECT *, ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS d FROM events)""")
def q_scalar_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fixtures.table(spark, sf_dir, "events")
    d = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor(F.col("value") * 60.0))
    return ev.select("event_id", F.col("ts").alias("pickup_datetime"), d.alias("dropoff_datetime")) \
        .select("event_id", "pickup_datetime", "dropoff_datetime",
                F.to_date("pickup_datetime").alias("pickup_date"),
                F.hour("pickup_datetime").cast("long").alias("pickup_hour"),
                columns.minute_boundaries("pickup_datetime", "dropoff_datetime").alias("duration_min"),
                columns.minute_boundaries("dropoff_datetime", "pickup_datetime").alias("reverse_min"))


@register("scalar_round", covers="D2 ROUND(x, 2) and whole cents",
          oracle=f"""
SELECT event_id, value / 8 AS x, {O.round2_sql('value / 8')} AS x_round2,
       {O.cents_sql('value / 8')} AS x_cents,
       {O.round2_sql('-value / 8')} AS neg_round2
FROM events""")
def q_scalar_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("value") / 8.0
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", x.alias("x"), columns.round2(x).alias("x_round2"),
        columns.cents(x).alias("x_cents"), columns.round2(-x).alias("neg_round2"))


@register("scalar_iso", covers="UTC ISO text with Z",
          oracle=f"""
SELECT event_id, {O.iso_sql('ts')} AS ts_iso,
       {O.iso_sql('CAST(CAST(ts AS DATE) AS TIMESTAMP)')} AS day_iso
FROM events""")
def q_scalar_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fixtures.table(spark, sf_dir, "events")
    return ev.select("event_id", columns.iso_utc("ts").alias("ts_iso"),
                     columns.iso_utc(F.to_date("ts").cast("timestamp_ntz")).alias("day_iso"))


# --- streaming ingestion ------------------------------------------------------------------

_LANDINGS = 4
_LANDING_SQL = f"(day(pickup_datetime) % {_LANDINGS})"


def _landed(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """Trips of one landing: those of every fourth day of the month."""
    return (fixtures.trips(spark, sf_dir).select(*TRIP_COLUMNS)
            .where(F.dayofmonth("pickup_datetime") % _LANDINGS == part))


def _named_batch(checkpoints: dict[str, str], spark: SparkSession) -> Column:
    """``source_batch_id`` with each query's own id, which is random, written as its name."""
    out = F.col("source_batch_id")
    for name, checkpoint in checkpoints.items():
        out = F.replace(out, F.lit(ingest.query_id_of(spark, checkpoint)), F.lit(name))
    return out


@register("stream_ingest", covers="S4 by Structured Streaming (availableNow, foreachBatch)",
          oracle=O.with_(O.TRIPS) + f"""
SELECT {O.TRIP_COLS}, CAST(pickup_datetime AS DATE) AS pickup_date,
       'stream-one-0000000' || CAST({_LANDING_SQL} AS VARCHAR) AS batch_id,
       'stream-one-0000000' || CAST({_LANDING_SQL} AS VARCHAR) AS batch_folder
FROM trips""")
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips land in four turns; after each the streaming query, started again on its
    checkpoint, drains what is new into bronze as one batch."""
    apply_job_conf(spark)
    landing, out = fresh_path(spark, "landing"), fresh_path(spark, "bronze-stream")
    checkpoint = fresh_path(spark, "stream-checkpoint")
    for part in range(_LANDINGS):
        _landed(spark, sf_dir, part).write.mode("append").parquet(landing)
        ingest.drain_into_bronze(spark, landing, out, checkpoint)
    named = _named_batch({"one": checkpoint}, spark)
    return bronze.scan_bronze(spark, out).select(
        *TRIP_COLUMNS, "pickup_date", named.alias("batch_id"),
        F.replace(F.col("batch_key"), F.lit(ingest.query_id_of(spark, checkpoint)), F.lit("one")).alias("batch_folder"))


@register("stream_two_queries", covers="S4: two streams with the default prefix into one bronze",
          oracle=O.with_(O.TRIPS) + f"""
SELECT {O.TRIP_COLS}, 'stream-' || CASE WHEN {_LANDING_SQL} < 2 THEN 'one' ELSE 'two' END || '-00000000' AS batch_id
FROM trips""")
def q_stream_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    out, checkpoints = fresh_path(spark, "bronze-streams"), {}
    for name, parts in (("one", (0, 1)), ("two", (2, 3))):
        landing, checkpoints[name] = fresh_path(spark, "landing"), fresh_path(spark, "stream-checkpoint")
        for part in parts:
            _landed(spark, sf_dir, part).write.mode("append").parquet(landing)
        ingest.drain_into_bronze(spark, landing, out, checkpoints[name])
    return bronze.scan_bronze(spark, out).select(*TRIP_COLUMNS, _named_batch(checkpoints, spark).alias("batch_id"))


# --- incremental silver -------------------------------------------------------------------

_FIRST_BATCHES, _LATER_BATCHES = ("batch_0", "batch_1"), ("batch_2", "batch_3", "batch_4")


def _incremental_warehouse(spark: SparkSession, sf_dir: str, change=lambda trips: trips) -> job.JobPaths:
    """Full build over the legacy rows and two batches, then three batches folded in
    one at a time; must equal the full build over everything."""
    apply_job_conf(spark)
    paths = job.resolve_paths(fresh_path(spark, "warehouse-inc"))
    trips = change(fixtures.trips(spark, sf_dir))
    batch = F.col("source_batch_id")
    bronze.write_bronze(trips.where(batch.isNull() | batch.isin(*_FIRST_BATCHES)), paths.bronze_dir)
    job.run_transforms(spark, paths)
    for b in _LATER_BATCHES:
        bronze.write_bronze(trips.where(batch == b), paths.bronze_dir)
        job.run_transforms_incremental(spark, paths)
    return paths


@register("silver_incremental", covers="S5 W1 incremental maintenance = full refresh",
          oracle=O.with_(O.TRIPS, O.SILVER) + "\nSELECT * FROM silver")
def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.read_silver(spark, _incremental_warehouse(spark, sf_dir).silver_dir)


@register("fct_trip_hourly_incremental", covers="A1 incremental maintenance = full refresh",
          oracle=O.with_(O.TRIPS, O.SILVER) + O.fact_from("silver"))
def q_fct_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.read_fact(spark, _incremental_warehouse(spark, sf_dir).fact_dir)


def _batches_so_far(n: int) -> str:
    names = ", ".join(f"'{b}'" for b in [*_FIRST_BATCHES, *_LATER_BATCHES[:n]])
    return f"upto_{n} AS (SELECT * FROM trips WHERE source_batch_id IS NULL OR source_batch_id IN ({names}))"


@register("trip_dates_incremental", covers="W1: the id table beside silver names every date that held a trip after any build",
          oracle=O.with_(O.TRIPS, *[c for n in range(4) for c in (_batches_so_far(n), O.silver_from(f"upto_{n}", f"silver_{n}"))])
          + "\nUNION ".join(f"\nSELECT trip_id, pickup_date FROM silver_{n}" for n in range(4)))
def q_trip_dates_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _incremental_warehouse(spark, sf_dir)
    table = tripdates.opened(spark, paths.silver_dir, read_text(spark, job.state_path(paths.silver_dir)))
    return table.rows().select("trip_id", "pickup_date").distinct()


@register("fct_trip_hourly_incremental_extremes",
          covers="A1 D3: the fact kept by differences, with parts of cents, huge, NaN and infinite amounts",
          oracle=O.with_(O.TRIPS, _EXTREMES_SQL.replace("FROM silver", "FROM trips"), O.silver_from("extremes"))
          + O.fact_from("silver"))
def q_fct_incremental_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.read_fact(spark, _incremental_warehouse(spark, sf_dir, _with_extremes).fact_dir)


# --- the job twice: a full first run, then the default incremental run --------------------

_INC_RUNS = ("job-taxi-2024-01-02", "job-taxi-2024-03-04")


def _norm_cte(name: str, months: str) -> str:
    return (f"{name} AS (" + O.normalize_sql(f"(SELECT * FROM raw_months WHERE k IN ({months}))",
                                            "tpep_pickup_datetime", "tpep_dropoff_datetime") + ")")


_JOB_INC_SQL = O.with_(
    _MONTH_SHIFT_SQL, O.raw_taxi_sql("ev", "raw_m", ", k"), _RAW_MONTHS_SQL,
    _norm_cte("taxi1", "0, 1"), _norm_cte("taxi2", "2, 3"), f"""
b2 AS (SELECT * FROM taxi2 WHERE pickup_datetime IS NOT NULL),
b AS (SELECT *, '{_INC_RUNS[0]}' AS source_batch_id, TIMESTAMP '2000-01-01' AS ingested_at
      FROM taxi1 WHERE pickup_datetime IS NOT NULL
      UNION ALL
      SELECT *, '{_INC_RUNS[1]}', TIMESTAMP '2000-01-02' FROM b2)""",
    O.silver_from("b"), O.FACT_CTE,
    "report AS (" + O.report_sql("silver", O.SILVER_CHECKS_SQL) + ")") + f"""
SELECT '{_INC_RUNS[1]}' AS run_id, 'taxi_yellow' AS source_name,
       CASE WHEN (SELECT bool_and(passed) FROM report) THEN 'succeeded' ELSE 'failed' END AS status,
       (SELECT min(CAST(pickup_datetime AS DATE)) FROM b2) AS data_start_date,
       (SELECT count(*) FROM b2) AS bronze_rows,
       (SELECT count(DISTINCT CAST(pickup_datetime AS DATE)) FROM b2) AS bronze_files,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM fact) AS gold_rows,
       (SELECT count(*) FROM (SELECT pickup_zone_id FROM silver UNION SELECT dropoff_zone_id FROM silver))
         AS dim_zone_rows,
       (SELECT bool_and(passed) FROM report) AS quality_passed,
       (SELECT CAST(count_if(passed) AS INTEGER) FROM report) AS checks_passed,
       (SELECT CAST(count_if(NOT passed) AS INTEGER) FROM report) AS checks_failed,
       CASE WHEN (SELECT bool_and(passed) FROM report) THEN NULL ELSE 'Quality checks failed' END
         AS error_message,
       'incremental' AS transform_mode,
       (SELECT string_agg(CAST(failures AS VARCHAR), ',' ORDER BY check_order) FROM report)
         AS check_failures"""


@register("medallion_job_incremental",
          covers="R1 with the default incremental mode: checks carried forward, zone counts",
          oracle=_JOB_INC_SQL)
def q_medallion_job_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one warehouse: January-February (full build), then March-April
    (folded in incrementally). The second run's audit row, the mode it took and its
    failures per check, which it carried forward from the first run's report."""
    apply_job_conf(spark)
    files = _write_months(spark, sf_dir, fresh_path(spark, "taxi-months-landing"))
    root = fresh_path(spark, "warehouse")
    for run_id, part in zip(_INC_RUNS, (files[:2], files[2:])):
        summary = job.run_job(spark, root, run_id=run_id, source="taxi", dataset="yellow",
                              source_path=part, raise_on_failure=False)
    runs = audit.latest_runs(audit.read_runs(spark, job.resolve_paths(root).runs_dir))
    failures = ",".join(str(int(c["failures"])) for c in summary["quality"]["checks"])
    return runs.where(F.col("run_id") == _INC_RUNS[1]).select(
        *_JOB_COLS, F.lit(summary["transforms"]["mode"]).alias("transform_mode"),
        F.lit(failures).alias("check_failures"))


# --- bronze merged --------------------------------------------------------------------------

_MERGED_PARTS, _MERGED_AGAIN = 4, 1
_PART_SQL = f"(hour(pickup_datetime) % {_MERGED_PARTS})"


@register("bronze_merged", covers="S4 S3 R1: small files merged twice, a merged batch written again in part, a run folded in after it",
          oracle=O.with_(O.TRIPS) + f"""
SELECT {O.TRIP_COLS.replace('fare_amount', 'CASE WHEN again THEN fare_amount + 1.0 ELSE fare_amount END AS fare_amount')},
       source_batch_id, CASE WHEN again THEN '2024-02-09T00:00:00Z' ELSE '2024-02-0' || (part + 1) || 'T00:00:00Z' END AS ingested_at,
       pickup_date, {O.batch_key_sql("source_batch_id")} AS batch_key, 'full,full,incremental' AS modes
FROM (SELECT * EXCLUDE (source_batch_id, ingested_at), {_PART_SQL} AS part, 'part/' || {_PART_SQL} AS source_batch_id,
             CAST(pickup_datetime AS DATE) AS pickup_date,
             {_PART_SQL} = {_MERGED_AGAIN} AND day(pickup_datetime) <= {_REPLAY_LAST_DAY} AS again FROM trips)""")
def q_bronze_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips land in four batches by pickup hour. Three are built and merged, one of them is written again for
    half of its dates, all is built and merged again, and the fourth is folded in."""
    apply_job_conf(spark)
    root = fresh_path(spark, "warehouse-merged")
    paths = job.resolve_paths(root)
    trips = fixtures.trips(spark, sf_dir).select(*TRIP_COLUMNS)

    def land(part: int, rows: DataFrame, day: int) -> None:
        bronze.write_bronze(rows.where(F.hour("pickup_datetime") % _MERGED_PARTS == part), paths.bronze_dir,
                            batch_id=f"part/{part}", ingested_at=datetime(2024, 2, day, tzinfo=UTC))

    modes = []
    for part in range(_MERGED_PARTS - 1):
        land(part, trips, part + 1)
    modes.append(job.run_transforms_incremental(spark, paths).mode)
    job.merge_bronze(spark, root, least_files=2)
    land(_MERGED_AGAIN, trips.where(F.dayofmonth("pickup_datetime") <= _REPLAY_LAST_DAY)
         .withColumn("fare_amount", F.col("fare_amount") + 1.0), 9)
    modes.append(job.run_transforms_incremental(spark, paths).mode)
    job.merge_bronze(spark, root, least_files=2)
    land(_MERGED_PARTS - 1, trips, _MERGED_PARTS)
    modes.append(job.run_transforms_incremental(spark, paths).mode)
    return bronze.scan_files(spark, paths.bronze_dir).select(*_BRONZE_COLS.split(", "), F.lit(",".join(modes)).alias("modes"))


# --- the job and bronze that others wrote ---------------------------------------------------

_FOREIGN_COLS = [c for c in O.SILVER_COLS.split(", ") if c not in ("ingested_at", "source_batch_id")]


@register("job_after_foreign_batches", covers="R1 R2: the default job folds in what a stream and a direct writer added",
          oracle=O.with_(O.TRIPS, f"""
written AS (SELECT * REPLACE (
              CASE {_LANDING_SQL} WHEN 0 THEN 'job-first' WHEN 1 THEN 'stream' WHEN 2 THEN 'direct/write' ELSE 'job-last' END
                AS source_batch_id,
              TIMESTAMP '2000-01-01' + to_days(CAST({_LANDING_SQL} AS INTEGER)) AS ingested_at)
            FROM trips)""", O.silver_from("written")) + f"""
SELECT {', '.join(_FOREIGN_COLS)}, source_batch_id AS batch, 'incremental' AS transform_mode FROM silver""")
def q_job_after_foreign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job, a stream's drain, a plain bronze write and a job again: silver as a full build has it."""
    apply_job_conf(spark)
    root = fresh_path(spark, "warehouse-foreign")
    paths = job.resolve_paths(root)
    job.run_job(spark, root, run_id="job-first", source="frame", trips=_landed(spark, sf_dir, 0), raise_on_failure=False)
    landing = fresh_path(spark, "landing")
    _landed(spark, sf_dir, 1).write.parquet(landing)
    ingest.drain_into_bronze(spark, landing, paths.bronze_dir, fresh_path(spark, "stream-checkpoint"))
    bronze.write_bronze(_landed(spark, sf_dir, 2), paths.bronze_dir, batch_id="direct/write", ingested_at=datetime.now(UTC))
    summary = job.run_job(spark, root, run_id="job-last", source="frame", trips=_landed(spark, sf_dir, 3),
                          raise_on_failure=False)
    batch = F.when(F.col("source_batch_id").startswith("stream-"), "stream").otherwise(F.col("source_batch_id"))
    return job.read_silver(spark, paths.silver_dir).select(
        *_FOREIGN_COLS, batch.alias("batch"), F.lit(summary["transforms"]["mode"]).alias("transform_mode"))


_VERSION_RUNS = ("v-first", "v-second", "v-third", "v-second")


@register("job_published_versions", covers="S5 D10 R1: two versions published by pointer, a run folded into the second, a batch made again",
          oracle=O.with_(O.TRIPS, f"""
written AS (SELECT * REPLACE (
              CASE {_LANDING_SQL} WHEN 0 THEN 'v-first' WHEN 1 THEN 'v-second' WHEN 2 THEN 'v-third' ELSE 'v-second' END
                AS source_batch_id,
              TIMESTAMP '2000-01-01' + to_days(CAST(CASE {_LANDING_SQL} WHEN 1 THEN 3 ELSE {_LANDING_SQL} END AS INTEGER))
                AS ingested_at)
            FROM trips)""", O.silver_from("written"), O.FACT_CTE) + """
SELECT fact.*, (SELECT count(*) FROM silver) AS silver_rows FROM fact""")
def q_job_published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact and the size of silver, both of the version that the pointer names in the end."""
    apply_job_conf(spark)
    root = fresh_path(spark, "warehouse-versions")
    lenient = {c.name: 10 ** 12 for c in quality.silver_expectations()}
    for part, run in enumerate(_VERSION_RUNS):
        job.run_job(spark, root, run_id=run, source="frame", trips=_landed(spark, sf_dir, part), max_failures=lenient,
                    publish_only_if_passed=run != "v-third")
    tables = job.published(spark, job.resolve_paths(root))
    return job.read_fact(spark, tables.fact_dir).crossJoin(
        job.read_silver(spark, tables.silver_dir).agg(F.count(F.lit(1)).alias("silver_rows")))


@register("medallion_job_mixed_bronze", covers="R1 S3 U2 P15: current, older and flat bronze files side by side",
          oracle=O.with_(O.TRIPS, """
written AS (SELECT * REPLACE (
              CASE WHEN source_batch_id IS NULL THEN NULL
                   WHEN source_batch_id = 'batch_4' THEN TIMESTAMP '2100-01-01' ELSE ingested_at END AS ingested_at)
            FROM trips)""", O.silver_from("written")) + f"""
SELECT {', '.join(_FOREIGN_COLS)}, source_batch_id FROM silver""")
def q_medallion_job_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a batch lie in bronze as older writers left them, in date folders without
    a batch level and as flat files with other types; the job ingests the last batch."""
    apply_job_conf(spark)
    root = fresh_path(spark, "warehouse-mixed")
    paths = job.resolve_paths(root)
    trips, batch = fixtures.trips(spark, sf_dir), F.col("source_batch_id")
    early = F.dayofmonth("pickup_datetime") <= 15
    (bronze.legacy_payload(trips.where(batch.isNull() & early))
     .write.partitionBy("pickup_date").parquet(paths.bronze_dir))
    (trips.where(batch.isNull() & ~early).select(*TRIP_COLUMNS).withColumn("pickup_zone_id", F.col("pickup_zone_id").cast("double"))
     .write.parquet(f"{paths.bronze_dir}/flat"))
    bronze.write_bronze(trips.where(batch.isNotNull() & (batch != "batch_4")), paths.bronze_dir)
    job.run_job(spark, root, run_id="batch_4", source="frame", trips=trips.where(batch == "batch_4"), raise_on_failure=False)
    return job.read_silver(spark, paths.silver_dir).select(*_FOREIGN_COLS, "source_batch_id")


@register("run_summary_stored", covers="S8 R3: the run summary read back from its JSON file",
          oracle=_JOB_SQL.replace("SELECT '" + _JOB_RUN, "SELECT run_id, status, source_name, dataset, bronze_rows, silver_rows, "
                                  "gold_rows, checks_passed, checks_failed, error_message FROM (SELECT 'yellow' AS dataset, '" + _JOB_RUN)
          + ")")
def q_run_summary_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    root, taxi_root = fresh_path(spark, "warehouse"), fresh_path(spark, "taxi-landing")
    fixtures.raw_taxi(spark, sf_dir).write.parquet(taxi.monthly_path(taxi_root, "yellow", _TAXI_YEAR, _TAXI_MONTH))
    job.run_job(spark, root, run_id=_JOB_RUN, source="taxi", dataset="yellow", year=_TAXI_YEAR,
                month=_TAXI_MONTH, taxi_root=taxi_root, raise_on_failure=False)
    stored = spark.read.json(job.summary_path(job.resolve_paths(root), _JOB_RUN))
    return stored.select("run_id", "status", F.col("ingestion.source_name").alias("source_name"),
                         F.col("config.dataset").alias("dataset"), F.col("ingestion.rows_written").alias("bronze_rows"),
                         F.col("transforms.silver_rows").alias("silver_rows"), F.col("transforms.gold_rows").alias("gold_rows"),
                         F.col("checks_passed").cast("int").alias("checks_passed"),
                         F.col("checks_failed").cast("int").alias("checks_failed"), "error_message")


@register("export_zones", covers="S6 U1: the exported dimension read back",
          oracle=O.with_(O.TRIPS, O.SILVER) + """
SELECT zone_id, 'Zone ' || CAST(zone_id AS VARCHAR) AS zone_label
FROM (SELECT pickup_zone_id AS zone_id FROM silver UNION SELECT dropoff_zone_id FROM silver)""")
def q_export_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    paths = job.resolve_paths(fresh_path(spark, "warehouse"))
    bronze.write_bronze(fixtures.trips(spark, sf_dir), paths.bronze_dir)
    job.run_transforms(spark, paths)
    return spark.read.parquet(paths.zones_dir)
