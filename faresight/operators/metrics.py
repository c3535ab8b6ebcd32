"""Dashboard queries over the hourly fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresight.functions.columns import (BEYOND, high_part, low_part, nan_to_null, of_parts, parts_count, parts_mean2,
                                         parts_sum2, parts_total, round2, sum_parts)

SERIES_ORDER = ["pickup_date", "pickup_hour", "zone_id"]


def hourly_series(fact: DataFrame) -> DataFrame:
    """Fact rows with the date as a timestamp, ordered by date, hour and zone."""
    return (fact.select(F.col("pickup_date").cast("timestamp_ntz").alias("pickup_date"),
                        "pickup_hour", "zone_id", "trip_count", "avg_trip_distance",
                        "avg_fare_amount", "total_revenue")
                .orderBy(*SERIES_ORDER))


def hourly_head(fact: DataFrame, n: int = 50) -> DataFrame:
    """First ``n`` rows of the ordered series (top-k, no full sort)."""
    return hourly_series(fact).limit(n)


def dashboard_kpis(fact: DataFrame) -> DataFrame:
    """Total trips, total revenue, the unweighted mean of hourly average fares
    (as the dashboard shows it) and the trip-weighted mean beside it.

    NaN counts as missing: such a group is in no mean and adds no revenue. An
    infinite value shows in the result. Sums are exact in two parts, so the
    figures do not depend on the order in which partitions are added, however
    large the amounts.
    """
    fare, revenue, trips = nan_to_null("avg_fare_amount"), nan_to_null("total_revenue"), F.col("trip_count")
    times = trips.cast("decimal(10,0)")
    agg = fact.agg(
        F.sum("trip_count").alias("total_trips"),
        *sum_parts(revenue, "revenue"), *sum_parts(fare, "fare"),
        # fares times trips, in the same two parts
        F.sum((high_part(fare) * times).cast("decimal(29,0)")).alias("weighted_high"),
        F.sum((low_part(fare) * times).cast("decimal(28,9)")).alias("weighted_low"),
        F.sum(F.when(F.abs(fare) >= F.lit(BEYOND), fare * trips)).alias("weighted_far"),
        F.sum(F.when(fare.isNotNull(), trips)).alias("weight"),
    )
    weight = F.col("weight")
    plain = F.round(F.col("weighted_low").cast("double") * 100 / weight) / F.lit(100.0)
    weighted = of_parts("fare", plain, round2(parts_total("weighted") / weight))
    return agg.select(
        "total_trips",
        parts_sum2("revenue").alias("total_revenue"),
        parts_mean2("fare").alias("avg_fare_unweighted"),
        F.when(parts_count("fare") > 0, weighted).alias("avg_fare_weighted"),
    )
