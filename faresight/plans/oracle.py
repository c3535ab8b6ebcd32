"""DuckDB statements that state the same results as the registered queries.

They run over the base tables only (``events``, ``lineitem`` ...), so each
statement rebuilds the views it needs in a ``WITH`` clause. The fragments
below are combined per query in ``ORACLE_SQL``.
"""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT concat('trip_', CAST(CASE WHEN event_id % 5 = 4 THEN event_id - 1 ELSE event_id END AS VARCHAR)) AS trip_id,
         ts AS pickup_datetime,
         CASE WHEN event_id % 211 = 0 THEN NULL
              ELSE ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) END AS dropoff_datetime,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 8 END AS passenger_count,
         value - 1.0 AS trip_distance,
         user_id % 50 + 1 AS pickup_zone_id,
         event_id % 50 + 1 AS dropoff_zone_id,
         value * 2.0 - 3.0 AS fare_amount,
         CAST(0.0 AS DOUBLE) AS tip_amount,
         CASE WHEN event_id % 97 = 0 THEN value ELSE value * 2.0 - 2.5 END AS total_amount,
         CASE event_type WHEN 'view' THEN 'card' WHEN 'click' THEN 'cash' WHEN 'purchase' THEN 'app'
                         ELSE 'unknown' END AS payment_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ingested_at,
         CASE WHEN event_id % 3 = 0 THEN NULL
              ELSE concat('batch_', CAST(event_id % 5 AS VARCHAR)) END AS source_batch_id
  FROM events
)"""

def raw_taxi_sql(src: str = "events", name: str = "raw_taxi", extra: str = "") -> str:
    """Raw yellow-layout records over an events-shaped relation (``extra`` adds columns)."""
    return f"""
{name} AS (
  SELECT CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 2 + 1 END AS VendorID,
         CASE WHEN event_id % 101 = 0 THEN 'not a time'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS tpep_pickup_datetime,
         CASE WHEN event_id % 211 = 0 THEN NULL
              ELSE strftime(ts + to_seconds(CAST(floor(value * 60) AS BIGINT)), '%Y-%m-%d %H:%M:%S')
              END AS tpep_dropoff_datetime,
         CASE WHEN event_id % 13 = 0 THEN 'x' ELSE CAST(event_id % 8 AS VARCHAR) END AS passenger_count,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 8 END AS trip_distance,
         CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(user_id % 50 + 1 AS DOUBLE) END AS PULocationID,
         CAST(event_id % 50 + 1 AS DOUBLE) AS DOLocationID,
         value * 2.0 - 3.0 AS fare_amount,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE value / 16 END AS tip_amount,
         value * 2.0 - 2.5 AS total_amount,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 8 AS DOUBLE) END AS payment_type{extra}
  FROM {src}
)"""


RAW_TAXI = raw_taxi_sql()

RUNS = """
runs AS (
  SELECT concat('run_', CAST(user_id AS VARCHAR)) AS run_id,
         CASE WHEN event_id % 2 = 0 THEN 'synthetic' ELSE 'taxi_yellow' END AS source_name,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status,
         ts AS started_at,
         value AS duration_seconds,
         event_id AS bronze_rows,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_id - event_id % 10 END AS silver_rows,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 1000 END AS gold_rows,
         event_type <> 'error' AS quality_passed
  FROM events
)"""

TRIP_COLS = ("trip_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, "
             "pickup_zone_id, dropoff_zone_id, fare_amount, tip_amount, total_amount, payment_type")

SILVER_COLS = TRIP_COLS + (", ingested_at, source_batch_id, pickup_date, pickup_hour, "
                           "trip_duration_min")

RANK_ORDER = ("ingested_at DESC NULLS LAST, dropoff_datetime DESC NULLS LAST, "
              "source_batch_id DESC NULLS LAST, pickup_datetime DESC NULLS LAST, "
              "fare_amount DESC NULLS LAST, total_amount DESC NULLS LAST, "
              "trip_distance DESC NULLS LAST, tip_amount DESC NULLS LAST, "
              "passenger_count DESC NULLS LAST, pickup_zone_id DESC NULLS LAST, "
              "dropoff_zone_id DESC NULLS LAST, payment_type DESC NULLS LAST")


def silver_from(src: str, name: str = "silver") -> str:
    """typed -> valid -> newest per trip -> derived, over relation ``src``."""
    return f"""
{name}_typed AS (
  SELECT {TRIP_COLS},
         COALESCE(ingested_at, pickup_datetime) AS ingested_at,
         COALESCE(source_batch_id, 'legacy') AS source_batch_id
  FROM {src}
),
{name}_valid AS (
  SELECT * FROM {name}_typed
  WHERE trip_distance > 0 AND fare_amount > 0 AND dropoff_datetime > pickup_datetime
),
{name}_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY trip_id ORDER BY {RANK_ORDER}) AS copy_no
  FROM {name}_valid
),
{name} AS (
  SELECT {TRIP_COLS}, ingested_at, source_batch_id,
         CAST(pickup_datetime AS DATE) AS pickup_date,
         EXTRACT('hour' FROM pickup_datetime) AS pickup_hour,
         DATE_DIFF('minute', pickup_datetime, dropoff_datetime) AS trip_duration_min
  FROM {name}_ranked WHERE copy_no = 1
)"""


def round2_sql(x: str) -> str:
    """round(x, 2) half away from zero; ``+ 0.0`` turns -0.0 into 0.0 as Spark returns it."""
    return f"(round({x} * 100) / 100 + 0.0)"


def cents_sql(x: str) -> str:
    return f"TRY_CAST(round({x} * 100) AS BIGINT)"


def exact_sql(x: str) -> str:
    """A double as a decimal of nine digits; NULL for NaN, infinity and beyond 10^15."""
    return f"CASE WHEN isfinite({x}) THEN TRY_CAST({x} AS DECIMAL(24,9)) END"


def if_exact_sql(x: str, by_decimal: str, by_double: str) -> str:
    return f"CASE WHEN count({exact_sql(x)}) = count({x}) THEN {by_decimal} ELSE {by_double} END"


def mean2_sql(x: str) -> str:
    """ROUND(AVG(x), 2) over exact decimals: the sum in hundredths, divided and rounded once."""
    cents = f"CAST(sum(({exact_sql(x)}) * CAST(100 AS DECIMAL(3,0))) AS DOUBLE)"
    return if_exact_sql(x, f"round({cents} / count({x})) / 100", round2_sql(f"(sum({x}) / count({x}))"))


def sum2_sql(x: str) -> str:
    """ROUND(SUM(x), 2) over exact decimals."""
    return if_exact_sql(x, f"CAST(round(sum({exact_sql(x)}), 2) AS DOUBLE)", round2_sql(f"sum({x})"))


def fact_from(src: str) -> str:
    return f"""
SELECT pickup_date, pickup_hour, pickup_zone_id AS zone_id,
       COUNT(*) AS trip_count,
       {mean2_sql('trip_distance')} AS avg_trip_distance,
       {mean2_sql('fare_amount')} AS avg_fare_amount,
       {sum2_sql('total_amount')} AS total_revenue
FROM {src}
GROUP BY 1, 2, 3"""


def parts_sql(x: str, times: str = "1") -> str:
    """The sum of doubles below 2^111 (times a whole number) as one double: whole 2^49s and rests are added
    apart, as integers and decimals, so that the order of rows does not matter."""
    units = f"CAST(trunc({x} / {_dbl(2.0 ** 49)}) AS HUGEINT)"
    big = f"abs({x}) >= 1e15"
    high = f"sum(CASE WHEN {big} THEN {units} ELSE 0 END * {times})"
    rest = f"CASE WHEN {big} THEN {x} - CAST({units} AS DOUBLE) * {_dbl(2.0 ** 49)} ELSE {x} END"
    low = f"sum(CAST({rest} AS DECIMAL(24,9)) * CAST({times} AS DECIMAL(10,0)))"
    return f"(CAST({high} AS DOUBLE) * {_dbl(2.0 ** 49)} + CAST({low} AS DOUBLE))"


def huge_fact_from(src: str) -> str:
    """``fact_from`` for finite amounts of any size below 2^111."""
    return f"""
SELECT pickup_date, pickup_hour, pickup_zone_id AS zone_id, COUNT(*) AS trip_count,
       {mean2_sql('trip_distance')} AS avg_trip_distance,
       CASE WHEN max(abs(fare_amount)) < 1e15 THEN {mean2_sql('fare_amount')}
            ELSE {round2_sql(f"({parts_sql('fare_amount')} / count(fare_amount))")} END AS avg_fare_amount,
       CASE WHEN max(abs(total_amount)) < 1e15 THEN {sum2_sql('total_amount')}
            ELSE {round2_sql(parts_sql('total_amount'))} END AS total_revenue
FROM {src}
GROUP BY 1, 2, 3"""


def huge_kpis_from(fact: str) -> str:
    """``kpis_from`` for facts with amounts of 10^15 and more; infinite revenue shows."""
    finite = "CASE WHEN isfinite(revenue) THEN revenue END"
    weight = "sum(CASE WHEN fare IS NOT NULL THEN trip_count END)"
    return f"""
SELECT sum(trip_count) AS total_trips,
       CASE WHEN bool_or(isinf(revenue)) THEN 'inf'::DOUBLE ELSE {round2_sql(parts_sql(f'({finite})'))} END AS total_revenue,
       {round2_sql(f"({parts_sql('fare')} / count(fare))")} AS avg_fare_unweighted,
       {round2_sql(f"({parts_sql('fare', 'trip_count')} / {weight})")} AS avg_fare_weighted
FROM (SELECT trip_count, CASE WHEN NOT isnan(total_revenue) THEN total_revenue END AS revenue,
             CASE WHEN NOT isnan(avg_fare_amount) THEN avg_fare_amount END AS fare FROM {fact})"""


def kpis_from(fact: str) -> str:
    """Totals and mean fares over a fact; NaN is missing, infinity shows."""
    return f"""
SELECT sum(trip_count) AS total_trips, {sum2_sql('revenue')} AS total_revenue,
       {mean2_sql('fare')} AS avg_fare_unweighted,
       {if_exact_sql('fare', f"round(CAST(sum(({exact_sql('fare')}) * CAST(trip_count AS DECIMAL(10,0))) AS DOUBLE) * 100 / sum(CASE WHEN fare IS NOT NULL THEN trip_count END)) / 100",
                     round2_sql('(sum(fare * trip_count) / sum(CASE WHEN fare IS NOT NULL THEN trip_count END))'))}
         AS avg_fare_weighted
FROM (SELECT trip_count, CASE WHEN NOT isnan(total_revenue) THEN total_revenue END AS revenue,
             CASE WHEN NOT isnan(avg_fare_amount) THEN avg_fare_amount END AS fare FROM {fact})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SILVER = silver_from("trips")
FACT_CTE = f"fact AS ({fact_from('silver')})"


def _num_sql(x: str, is_text: bool) -> str:
    v = f"TRY_CAST({x} AS DOUBLE)" if is_text else f"CAST({x} AS DOUBLE)"
    return f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"


def _whole_sql(x: str) -> str:
    return f"TRY_CAST(trunc({x}) AS BIGINT)"


def _id_part_sql(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '<NA>')"


def normalize_sql(src: str, pickup: str, dropoff: str, vendor: str | None = "VendorID",
                  passenger_text: bool = True) -> str:
    """Normalized canonical trips over a raw taxi relation."""
    vendor_expr = _num_sql(vendor, False) if vendor else "CAST(NULL AS DOUBLE)"
    return f"""
SELECT 'tlc_' || md5(concat_ws('|',
           coalesce(strftime(p, '%Y-%m-%d %H:%M:%S.%f'), '<NA>'),
           coalesce(strftime(d, '%Y-%m-%d %H:%M:%S.%f'), '<NA>'),
           {_id_part_sql(_whole_sql('pu'))},
           {_id_part_sql(_whole_sql('dz'))},
           {_id_part_sql(cents_sql('fare'))},
           {_id_part_sql(cents_sql('total'))},
           {_id_part_sql(_whole_sql('vendor'))})) AS trip_id,
       p AS pickup_datetime,
       d AS dropoff_datetime,
       coalesce({_whole_sql('pc')}, 0) AS passenger_count,
       coalesce({round2_sql('dist')}, 0.0) AS trip_distance,
       coalesce({_whole_sql('pu')}, 0) AS pickup_zone_id,
       coalesce({_whole_sql('dz')}, 0) AS dropoff_zone_id,
       coalesce({round2_sql('fare')}, 0.0) AS fare_amount,
       coalesce({round2_sql('tip')}, 0.0) AS tip_amount,
       coalesce({round2_sql('total')}, 0.0) AS total_amount,
       CASE pay WHEN 1 THEN 'card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge'
                WHEN 4 THEN 'dispute' WHEN 5 THEN 'unknown' WHEN 6 THEN 'voided'
                ELSE 'unknown' END AS payment_type
FROM (
  SELECT TRY_CAST({pickup} AS TIMESTAMP) AS p,
         TRY_CAST({dropoff} AS TIMESTAMP) AS d,
         {_num_sql('passenger_count', passenger_text)} AS pc,
         {_num_sql('trip_distance', False)} AS dist,
         {_num_sql('PULocationID', False)} AS pu,
         {_num_sql('DOLocationID', False)} AS dz,
         {_num_sql('fare_amount', False)} AS fare,
         {_num_sql('tip_amount', False)} AS tip,
         {_num_sql('total_amount', False)} AS total,
         {_num_sql('payment_type', False)} AS pay,
         {vendor_expr} AS vendor
  FROM {src}
)"""


def iso_sql(ts: str) -> str:
    """Same text as columns.iso_utc: fraction only when non-zero, Z suffix."""
    return (f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN strftime({ts}, '%f') <> '000000' THEN '.' || strftime({ts}, '%f') ELSE '' END"
            f" || 'Z'")


def batch_key_sql(b: str) -> str:
    """Letters, digits, "-" and "_" stay, other bytes are "~" and two hex digits; "~" for no text."""
    return (f"CASE WHEN {b} = '' THEN '~' ELSE "
            f"replace(replace(replace(url_encode({b}), '.', '%2E'), '~', '%7E'), '%', '~') END")


# The eight checks on silver, in report order (name, failing-row predicate).
SILVER_CHECKS_SQL = [
    ("null_pickup_datetime", "pickup_datetime IS NULL"),
    ("null_dropoff_datetime", "dropoff_datetime IS NULL"),
    ("non_positive_distance", "trip_distance <= 0"),
    ("non_positive_fare", "fare_amount <= 0"),
    ("invalid_passenger_count", "passenger_count < 1 OR passenger_count > 6"),
    ("duplicate_trip_id", None),
    ("invalid_trip_duration", "trip_duration_min <= 0 OR trip_duration_min > 180"),
    ("total_amount_below_fare", "total_amount < fare_amount"),
]


def dup_count_sql(src: str, keys: str, ignore_null: bool = False) -> str:
    where = (" WHERE " + " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
             if ignore_null else "")
    return (f"(SELECT count(*) FROM (SELECT {keys} FROM {src}{where} "
            f"GROUP BY {keys} HAVING count(*) > 1))")


def report_sql(src: str, checks: list[tuple[str, str | None]], extra_cols: str = "",
               unique_keys: str = "trip_id", unique_ignore_null: bool = False) -> str:
    """One row per check: check_order, name, failures, max_failures (0), passed."""
    parts = []
    for i, (name, pred) in enumerate(checks, 1):
        failures = (f"(SELECT count_if({pred}) FROM {src})" if pred
                    else dup_count_sql(src, unique_keys, unique_ignore_null))
        parts.append(f"SELECT CAST({i} AS INTEGER) AS check_order, '{name}' AS name, "
                     f"CAST({failures} AS BIGINT) AS failures")
    body = "\n  UNION ALL ".join(parts)
    return (f"SELECT {extra_cols}check_order, name, failures, CAST(0 AS BIGINT) AS max_failures, "
            f"failures <= 0 AS passed FROM (\n  {body})")


def derived_sql(src: str, name: str, provenance: bool = True) -> str:
    """Typed trips with the silver-derived columns, no filter, no ranking."""
    ingested = "COALESCE(ingested_at, pickup_datetime)" if provenance else "pickup_datetime"
    batch = "COALESCE(source_batch_id, 'legacy')" if provenance else "'legacy'"
    return f"""
{name} AS (
  SELECT {TRIP_COLS},
         {ingested} AS ingested_at,
         {batch} AS source_batch_id,
         CAST(pickup_datetime AS DATE) AS pickup_date,
         EXTRACT('hour' FROM pickup_datetime) AS pickup_hour,
         DATE_DIFF('minute', pickup_datetime, dropoff_datetime) AS trip_duration_min
  FROM {src}
)"""


def _dbl(x: float) -> str:
    """A DOUBLE literal in DuckDB (an exponent makes it DOUBLE, not DECIMAL)."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def generated_trips_sql(ids: str, start_date: str, rows_per_day: int, seed: int) -> str:
    """The generator's rows over a relation ``ids(id)``, with the same digests and arithmetic."""
    from faresight.sources import generator as G

    digests = ",\n         ".join(
        f"sha256(concat_ws(':', '{seed}', '{b}', CAST(id AS VARCHAR))) AS h{b}" for b in range(3))
    uniforms = ",\n         ".join(
        f"CAST('0x' || substr(h{(k - 1) // 4}, {((k - 1) % 4) * 13 + 1}, 13) AS BIGINT)"
        f" / {_dbl(2.0 ** 52)} AS u{k}" for k in range(1, 13))
    cumulative, rate_cases = 0.0, []
    for rate, weight in zip(G.TIP_RATES[:-1], G.TIP_WEIGHTS[:-1]):
        cumulative += weight
        rate_cases.append(f"WHEN u9 < {_dbl(cumulative)} THEN {_dbl(rate)}")
    rate = f"CASE {' '.join(rate_cases)} ELSE {_dbl(G.TIP_RATES[-1])} END"
    labels = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(G.PAYMENT_LABELS[:-1]))
    pay = (f"CASE CAST(floor(u12 * {len(G.PAYMENT_LABELS)}) AS BIGINT) {labels} "
           f"ELSE '{G.PAYMENT_LABELS[-1]}' END")
    return f"""
g_hash AS (
  SELECT id, md5(concat_ws(':', '{seed}', CAST(id AS VARCHAR))) AS k,
         {digests}
  FROM {ids}),
g_u AS (
  SELECT id, k,
         {uniforms}
  FROM g_hash),
g_d AS (
  SELECT *,
         CAST(DATE '{start_date}' + CAST(id // {rows_per_day} AS INTEGER) AS TIMESTAMP)
           + to_seconds(CAST(floor(u1 * 86400) AS BIGINT)) AS pickup,
         {round2_sql('(-1.5e0 * ln((1.0e0 - u4) * (1.0e0 - u5)))')} AS distance,
         sqrt(-2.0e0 * ln(1.0e0 - u7)) * cos(2 * pi() * u8) AS normal
  FROM g_u),
g_f AS (
  SELECT *, {round2_sql('greatest((distance * (2.2e0 + 0.9e0 * u6) + 3.0e0) + normal, 3.0e0)')} AS fare
  FROM g_d),
g_t AS (
  SELECT *, {round2_sql(f'(fare * {rate})')} AS tip FROM g_f)
SELECT substr(k, 1, 8) || '-' || substr(k, 9, 4) || '-' || substr(k, 13, 4) || '-'
         || substr(k, 17, 4) || '-' || substr(k, 21, 12) AS trip_id,
       pickup AS pickup_datetime,
       pickup + to_seconds(CAST(180 + floor(u2 * 2520) AS BIGINT)) AS dropoff_datetime,
       CAST(1 + floor(u3 * 5) AS BIGINT) AS passenger_count,
       distance AS trip_distance,
       CAST(1 + floor(u10 * 50) AS BIGINT) AS pickup_zone_id,
       CAST(1 + floor(u11 * 50) AS BIGINT) AS dropoff_zone_id,
       fare AS fare_amount,
       tip AS tip_amount,
       {round2_sql('((fare + tip) + 0.5e0)')} AS total_amount,
       {pay} AS payment_type
FROM g_t"""
