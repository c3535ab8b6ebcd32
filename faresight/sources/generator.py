"""Seeded synthetic trips, generated on the executors.

Each row's values are functions of ``(seed, row id)`` through SHA-256
digests, so the output does not depend on partitioning, task order or
retries (a re-executed task regenerates identical rows), and any number of
rows can be produced without the driver holding them. The digests are the
standard function, so a SQL engine with ``sha256`` states the same rows
(``generated_trips_sql``).

Distributions (per row):

* pickup: a uniform second of its day; duration uniform in 180..2699 s
* passengers uniform in 1..5; zones uniform in 1..50
* distance gamma(shape 2, scale 1.5), rounded to 2 decimals
* fare = distance * U(2.2, 3.1) + N(3, 1), at least 3.00, rounded
* tip = fare * a weighted choice of rate; total = fare + tip + 0.50
* payment: one of three labels, uniform
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import round2
from faresight.schemas import TRIP_COLUMNS

# Payment labels of generated trips.
PAYMENT_LABELS = ["card", "cash", "app"]
# Tip rates and their probabilities.
TIP_RATES = [0.0, 0.1, 0.15, 0.2]
TIP_WEIGHTS = [0.2, 0.35, 0.3, 0.15]

# A digest is 64 hex digits; each uniform takes 13 of them (52 bits).
_HEX_PER_UNIFORM = 13
_UNIFORMS_PER_DIGEST = 4
_SCALE = float(1 << (4 * _HEX_PER_UNIFORM))


def _digest_text(seed: int, block: int, row_id: Column) -> Column:
    return F.concat_ws(":", F.lit(str(seed)), F.lit(str(block)), row_id.cast("string"))


def _uniforms(seed: int, row_id: Column, n: int) -> dict[int, Column]:
    """U[0, 1) number ``k`` (1..n) from hex digits of ``sha256(seed:block:id)``."""
    out = {}
    for k in range(1, n + 1):
        block, slot = divmod(k - 1, _UNIFORMS_PER_DIGEST)
        digest = F.sha2(_digest_text(seed, block, row_id), 256)
        digits = F.substring(digest, slot * _HEX_PER_UNIFORM + 1, _HEX_PER_UNIFORM)
        out[k] = F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(_SCALE)
    return out


def _weighted_choice(u: Column, values: list[float], weights: list[float]) -> Column:
    expr, cumulative = None, 0.0
    for value, weight in zip(values[:-1], weights[:-1]):
        cumulative += weight
        expr = (F.when(u < cumulative, F.lit(value)) if expr is None
                else expr.when(u < cumulative, F.lit(value)))
    return expr.otherwise(F.lit(values[-1]))


def trips_for_ids(ids: DataFrame, start_date: date, rows_per_day: int, seed: int = 42,
                  id_col: str = "id") -> DataFrame:
    """Synthetic trips for a column of non-negative row ids.

    Row ``i`` belongs to day ``i // rows_per_day`` after ``start_date``.
    """
    if rows_per_day <= 0:
        raise ValueError("rows_per_day must be positive")
    i = F.col(id_col).cast("long")
    u = _uniforms(seed, i, 12)
    day = F.date_add(F.lit(start_date), (i / F.lit(rows_per_day)).cast("int"))
    pickup = F.to_timestamp_ntz(day.cast("string")) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.floor(u[1] * 86400))
    duration = F.lit(180) + F.floor(u[2] * (2700 - 180))
    # 1 - u lies in (0, 1], safe under ln: gamma(2, 1.5) as -1.5 ln(v4 v5), Box-Muller normal
    distance = round2(F.lit(-1.5) * F.log((F.lit(1.0) - u[4]) * (F.lit(1.0) - u[5])))
    normal = (F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u[7]))
              * F.cos(F.lit(2 * math.pi) * u[8]))
    fare = round2(F.greatest(distance * (F.lit(2.2) + F.lit(0.9) * u[6]) + F.lit(3.0) + normal,
                             F.lit(3.0)))
    tip = round2(fare * _weighted_choice(u[9], TIP_RATES, TIP_WEIGHTS))
    payment = F.element_at(F.array(*[F.lit(p) for p in PAYMENT_LABELS]),
                           (F.floor(u[12] * len(PAYMENT_LABELS)) + 1).cast("int"))
    trip_key = F.md5(F.concat_ws(":", F.lit(str(seed)), i.cast("string")))
    trip_id = F.concat_ws("-", F.substring(trip_key, 1, 8), F.substring(trip_key, 9, 4),
                          F.substring(trip_key, 13, 4), F.substring(trip_key, 17, 4),
                          F.substring(trip_key, 21, 12))
    return (ids.select(
                trip_id.alias("trip_id"),
                pickup.alias("pickup_datetime"),
                (pickup + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), duration))
                .alias("dropoff_datetime"),
                (F.lit(1) + F.floor(u[3] * 5)).cast("long").alias("passenger_count"),
                distance.alias("trip_distance"),
                (F.lit(1) + F.floor(u[10] * 50)).cast("long").alias("pickup_zone_id"),
                (F.lit(1) + F.floor(u[11] * 50)).cast("long").alias("dropoff_zone_id"),
                fare.alias("fare_amount"),
                tip.alias("tip_amount"),
                round2(fare + tip + F.lit(0.5)).alias("total_amount"),
                payment.alias("payment_type"))
            .select(*TRIP_COLUMNS))


def generate_trips(spark: SparkSession, start_date: date, days: int, rows_per_day: int,
                   seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``days * rows_per_day`` trips from ``spark.range`` (no driver-side data)."""
    if days <= 0 or rows_per_day <= 0:
        raise ValueError("days and rows_per_day must be positive")
    ids = spark.range(0, days * rows_per_day, 1, partitions) if partitions else \
        spark.range(0, days * rows_per_day)
    return trips_for_ids(ids, start_date, rows_per_day, seed)
