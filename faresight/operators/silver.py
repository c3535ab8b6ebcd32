"""Silver layer: typed, valid, newest copy per trip.

Order matters (and is kept): rows are typed, then filtered for validity, and
only then ranked, so when the newest copy of a trip is invalid the newest
*valid* copy survives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faresight.functions.columns import as_ingest_time, minute_boundaries
from faresight.schemas import SILVER_COLUMNS, TRIP_SCHEMA

LEGACY_BATCH = "legacy"

# Newest copy first; the remaining columns only break exact ties so that the
# winner does not depend on partitioning.
RECENCY_ORDER = ["ingested_at", "dropoff_datetime"]
TIE_BREAK_ORDER = ["source_batch_id", "pickup_datetime", "fare_amount", "total_amount",
                   "trip_distance", "tip_amount", "passenger_count", "pickup_zone_id",
                   "dropoff_zone_id", "payment_type"]


def typed_trips(bronze: DataFrame) -> DataFrame:
    """Cast bronze (any stored layout) to silver types with provenance defaults.

    A missing ``ingested_at`` falls back to the pickup time and a missing
    ``source_batch_id`` to ``legacy``; columns absent from the input (legacy
    layout) are treated as null.
    """
    present = {f.name: f.dataType for f in bronze.schema.fields}

    def source(name: str, dtype) -> Column:
        return F.col(name).cast(dtype) if name in present else F.lit(None).cast(dtype)

    cols = [source(f.name, f.dataType).alias(f.name) for f in TRIP_SCHEMA.fields]
    pickup = source("pickup_datetime", "timestamp_ntz")
    ingested = (as_ingest_time("ingested_at", present["ingested_at"]) if "ingested_at" in present
                else F.lit(None).cast("timestamp_ntz"))
    batch = source("source_batch_id", "string")
    cols += [
        F.coalesce(ingested, pickup).alias("ingested_at"),
        F.coalesce(batch, F.lit(LEGACY_BATCH)).alias("source_batch_id"),
    ]
    return bronze.select(*cols)


def validity_condition() -> Column:
    """Positive distance and fare, dropoff after pickup (null fails)."""
    return ((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0)
            & (F.col("dropoff_datetime") > F.col("pickup_datetime")))


def valid_trips(bronze: DataFrame) -> DataFrame:
    """Typed bronze rows that pass the validity filter.

    The distance and fare predicates reach the parquet scan as pushed filters.
    """
    return typed_trips(bronze).where(validity_condition())


def newest_first_order(newest_first: Sequence[str], tie_break: Sequence[str] = ()) -> list[Column]:
    """The ordering of ``latest_per_key`` within a key: descending, nulls last."""
    return [F.col(c).desc_nulls_last() for c in [*newest_first, *tie_break]]


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str],
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row per key (``ROW_NUMBER() ... = 1``).

    ``newest_first`` columns sort descending with nulls last. Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so each map task sends at
    most one row per key: a key holding a large share of all rows costs one
    row per task in the exchange, not all of its copies.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first_order(newest_first, tie_break))
    return (df.withColumn("_rank", F.row_number().over(w))
              .where(F.col("_rank") == 1)
              .drop("_rank"))


def with_derived(df: DataFrame) -> DataFrame:
    """Pickup date, pickup hour and trip duration in minute boundaries."""
    return df.withColumns({
        "pickup_date": F.to_date("pickup_datetime"),
        "pickup_hour": F.hour("pickup_datetime").cast("long"),
        "trip_duration_min": minute_boundaries("pickup_datetime", "dropoff_datetime"),
    })


def silver_trips(bronze: DataFrame) -> DataFrame:
    """Full silver build: type, filter, keep newest per trip, derive, order columns."""
    valid = valid_trips(bronze)
    newest = latest_per_key(valid, ["trip_id"], RECENCY_ORDER, TIE_BREAK_ORDER)
    return with_derived(newest).select(*SILVER_COLUMNS)


# --- incremental maintenance ---------------------------------------------------------------
#
# Exact: silver keeps every ordering column, so the newest valid copy over old
# bronze plus a new batch is the newest of the stored winner and the batch's
# valid copies. Only the trips a batch carries are re-ranked. Trip ids match
# null-safely, so a null id stays one group as in the full build.

def batch_candidates(batch_bronze: DataFrame) -> DataFrame:
    """Valid rows of a new bronze batch, in silver form."""
    return with_derived(valid_trips(batch_bronze)).select(*SILVER_COLUMNS)


def dates_holding(silver: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct pickup dates of the stored rows of the given trip ids.

    Reads only the ``trip_id`` and ``pickup_date`` columns of silver, so full
    rows need to be read only from these dates.
    """
    keys = silver.select("trip_id", "pickup_date")
    return (keys.join(ids, keys["trip_id"].eqNullSafe(ids["trip_id"]), "left_semi")
                .select("pickup_date").distinct())


def stored_copies(silver: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored winners of the given trip ids (null-safe semi join)."""
    stored = silver.select(*SILVER_COLUMNS)
    return stored.join(ids, stored["trip_id"].eqNullSafe(ids["trip_id"]), "left_semi")


def rerank(stored: DataFrame, candidates: DataFrame) -> DataFrame:
    """New winners of the touched trips."""
    return latest_per_key(stored.unionByName(candidates), ["trip_id"], RECENCY_ORDER,
                          TIE_BREAK_ORDER)


def without_trips(silver: DataFrame, ids: DataFrame) -> DataFrame:
    """Silver rows whose trip id is not in ``ids`` (null-safe anti join)."""
    return silver.join(ids, silver["trip_id"].eqNullSafe(ids["trip_id"]), "left_anti")
