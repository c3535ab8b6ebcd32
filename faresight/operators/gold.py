"""Gold layer: hourly fact, zone dimension and the staging view.

Averages and sums are computed from exact sums in two parts and rounded once at
the end, so they do not depend on summation order (partitioning, AQE, engine),
huge amounts included. The sums can be stored and changed by the trips that come
and go, so that the fact follows without reading silver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import SUM_PARTS, parts_mean2, parts_sum2, sum_parts
from faresight.schemas import FACT_HOURLY_COLUMNS, SILVER_COLUMNS

STAGING_COLUMNS = list(SILVER_COLUMNS)


def stg_trips(silver: DataFrame) -> DataFrame:
    """Staging projection of silver (16 typed columns)."""
    return silver.select(*STAGING_COLUMNS)


def create_staging_view(spark: SparkSession, silver: DataFrame, name: str = "stg_trips") -> str:
    """Register the staging projection as a view of the session; returns its name."""
    stg_trips(silver).createOrReplaceTempView(name)
    return name


#: What the hourly fact measures, and what one row of it stands for.
MEASURES = ["trip_distance", "fare_amount", "total_amount"]
GROUP = ["pickup_date", "pickup_hour", "zone_id"]
HOURLY_SUMS_SCHEMA = ("pickup_date date, pickup_hour long, zone_id long, trip_count long, "
                      + ", ".join(f"{m}_{k} {t}" for m in MEASURES for k, t in SUM_PARTS.items()))


def hourly_sums(trips: DataFrame) -> DataFrame:
    """Trips and exact sums of the measures per date, hour and pickup zone (see ``columns.sum_parts``).

    One hash aggregation with fixed-width buffers: partial aggregation runs
    before the shuffle, so a hot (date, hour, zone) group sends one row per
    map task.
    """
    return (trips.groupBy("pickup_date", "pickup_hour", F.col("pickup_zone_id").alias("zone_id"))
                 .agg(F.count(F.lit(1)).alias("trip_count"), *[p for m in MEASURES for p in sum_parts(m, m)]))


def fact_from_sums(sums: DataFrame) -> DataFrame:
    """The hourly fact: means and revenue, each rounded once from its exact sum."""
    return sums.select(
        *GROUP, "trip_count",
        parts_mean2("trip_distance").alias("avg_trip_distance"),
        parts_mean2("fare_amount").alias("avg_fare_amount"),
        parts_sum2("total_amount").alias("total_revenue"),
    ).select(*FACT_HOURLY_COLUMNS)


def fct_trip_hourly(trips: DataFrame) -> DataFrame:
    """Trips, mean distance, mean fare and revenue per date, hour and pickup zone."""
    return fact_from_sums(hourly_sums(trips))


def stored_sums(sums: DataFrame) -> DataFrame:
    """``hourly_sums`` in the types they are stored in."""
    types = {f"{m}_{k}": t for m in MEASURES for k, t in SUM_PARTS.items()}
    return sums.select(*GROUP, "trip_count", *[F.col(c).cast(t).alias(c) for c, t in types.items()])


def changed_sums(stored: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Stored sums plus those of ``added`` trips minus those of ``removed`` trips; groups without trips go.

    Exact for every amount that ``columns.sum_parts`` adds exactly. Groups that
    keep amounts beyond that are told by ``far_dates`` and have to be summed anew.
    """
    parts = [f"{m}_{k}" for m in MEASURES for k in SUM_PARTS]
    minus = stored_sums(hourly_sums(removed)).select(*GROUP, (-F.col("trip_count")).alias("trip_count"),
                                                     *[(-F.col(c)).alias(c) for c in parts])
    every = stored_sums(stored).unionByName(stored_sums(hourly_sums(added))).unionByName(minus)
    merged = (every.groupBy(*GROUP).agg(F.sum("trip_count").alias("trip_count"), *[F.sum(c).alias(c) for c in parts])
                   .where(F.col("trip_count") > 0))
    return stored_sums(merged.withColumns({f"{m}_far": F.when(F.col(f"{m}_beyond") > 0, F.col(f"{m}_far")) for m in MEASURES}))


def far_dates() -> Column:
    """Aggregate over stored sums: the dates with a group that holds amounts whose sum is not kept exactly."""
    far = [F.col(f"{m}_beyond") > 0 for m in MEASURES]
    return F.collect_set(F.when(far[0] | far[1] | far[2], F.col("pickup_date"))).alias("far_dates")


def dim_zones(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct pickup and dropoff zones with a display label.

    One scan: both zone columns are stacked with ``explode(array(...))`` and
    de-duplicated by a hash aggregate (partial before the shuffle).
    """
    zones = (silver.select(F.explode(F.array("pickup_zone_id", "dropoff_zone_id")).alias("zone_id"))
                   .distinct())
    out = zones.select("zone_id",
                       F.concat(F.lit("Zone "), F.col("zone_id").cast("string")).alias("zone_label"))
    return out.orderBy("zone_id") if ordered else out


# --- zone references, for incremental maintenance of the dimension -------------------------
#
# A zone stays in the dimension while at least one silver row names it as its
# pickup or dropoff zone. Keeping the number of such references per zone lets
# an incremental run update the dimension from the rows it adds and removes,
# without scanning silver.

def zone_refs(trips: DataFrame) -> DataFrame:
    """Per zone (the null zone included): how many pickup and dropoff fields name it."""
    return (trips.select(F.explode(F.array("pickup_zone_id", "dropoff_zone_id")).alias("zone_id"))
                 .groupBy("zone_id").agg(F.count(F.lit(1)).alias("refs")))


def adjust_refs(refs: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Stored counts plus those of ``added`` rows minus those of ``removed`` rows."""
    removed_refs = zone_refs(removed).select("zone_id", (-F.col("refs")).alias("refs"))
    return (refs.unionByName(zone_refs(added)).unionByName(removed_refs)
                .groupBy("zone_id").agg(F.sum("refs").cast("long").alias("refs"))
                .where(F.col("refs") > 0))


def zones_from_refs(refs: DataFrame) -> DataFrame:
    """The dimension: every zone still referenced, with its label."""
    return refs.where(F.col("refs") > 0).select(
        "zone_id", F.concat(F.lit("Zone "), F.col("zone_id").cast("string")).alias("zone_label"))
