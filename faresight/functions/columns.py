"""Column expressions shared by all layers.

Every helper returns a built-in Spark expression (no Python UDF), so it runs
inside whole-stage codegen.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payment codes of the public taxi trip records and their labels.
# Any other code, a fractional code or a missing code is labelled "unknown".
PAYMENT_LABELS = {
    1: "card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided",
}
UNKNOWN_PAYMENT = "unknown"

# Fixed value: token standing for a missing field in the trip identity text.
NULL_TOKEN = "<NA>"

# Fixed value: what a trip id made from the trip itself begins with.
TRIP_ID_PREFIX = "tlc_"

# Type in which amounts are added exactly: nine decimals, up to 10^15. A sum of it times 100
# still has all its digits in Spark's widest decimal.
EXACT = "decimal(24,9)"

# Where amounts are split for exact sums: from BIG on into a whole number of UNITs, which below
# BEYOND is a long, and a rest; from BEYOND (about 10^33) on they are only counted.
BIG, UNIT, BEYOND = 1e15, 2.0 ** 49, 2.0 ** 111

#: Parts of an exact sum of doubles (see ``sum_parts``), with the types they are stored in.
SUM_PARTS = {"high": "decimal(38,0)", "low": "decimal(38,9)", "fit": "long", "nan": "long", "up": "long",
             "down": "long", "beyond": "long", "far": "double"}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_minute(ts: str | Column) -> Column:
    """Whole minutes since 1970-01-01 00:00 of a wall-clock (NTZ) timestamp.

    Built from the date, hour and minute fields, so it does not depend on the
    session time zone.
    """
    t = col(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * 1440
            + F.hour(t).cast("long") * 60 + F.minute(t).cast("long"))


def minute_boundaries(start: str | Column, end: str | Column) -> Column:
    """Number of minute boundaries crossed between two timestamps.

    08:00:59 -> 08:01:00 counts 1, 08:00:00 -> 08:00:59 counts 0: the
    difference of the two truncated minutes, not the elapsed minutes.
    """
    return epoch_minute(end) - epoch_minute(start)


def round2(x: str | Column) -> Column:
    """Round to 2 decimals, half away from zero on the value scaled by 100."""
    return F.round(col(x) * F.lit(100.0)) / F.lit(100.0)


def cents(x: str | Column) -> Column:
    """Amount in whole cents (half away from zero), null for NaN / overflow."""
    return F.round(col(x) * F.lit(100.0)).try_cast("long")


def exact(x: str | Column) -> Column:
    """A double as a decimal of nine digits after the point; null for NaN, infinity and beyond 10^15."""
    return col(x).try_cast(EXACT)


def high_part(x: str | Column) -> Column:
    """Whole ``UNIT``s of an amount of ``BIG`` or more, 0 below; null for NaN, infinity and from ``BEYOND`` on."""
    c = col(x)
    return (F.when(F.abs(c) < F.lit(BIG), F.lit(0).cast("decimal(19,0)"))
             .when(F.abs(c) < F.lit(BEYOND), (c / F.lit(UNIT)).cast("long").cast("decimal(19,0)")))


def low_part(x: str | Column) -> Column:
    """What ``high_part`` leaves of an amount, as a decimal; null where that is null."""
    c = col(x)
    rest = c - (c / F.lit(UNIT)).cast("long").cast("double") * F.lit(UNIT)
    return F.when(F.abs(c) < F.lit(BIG), exact(c)).when(F.abs(c) < F.lit(BEYOND), exact(rest))


def sum_parts(x: str | Column, name: str) -> list[Column]:
    """Aggregates that hold the sum of doubles without regard to their order.

    ``high`` and ``low`` are exact decimals, ``fit`` counts the amounts in
    them; NaN, the infinities and amounts from ``BEYOND`` on are counted, the
    last with their double sum ``far``. The parts of two sets of rows add up
    to those of their union, and those of removed rows can be subtracted
    (``far`` only where no such amount is left).
    """
    c = col(x)
    far = F.abs(c) >= F.lit(BEYOND)
    # two counts share a long: amounts that do not fit are rare, and a group holds fewer than 2^32 of a kind
    one, two = F.lit(1).cast("long"), F.lit(1 << 32)
    apart = F.sum(F.when(far, F.when(F.isnan(c), one).when(c == F.lit(float("inf")), two).otherwise(F.lit(0).cast("long"))))
    others = F.sum(F.when(far, F.when(c == F.lit(float("-inf")), one)
                                .when(F.isnan(c) | (c == F.lit(float("inf"))), F.lit(0).cast("long")).otherwise(two)))

    def low_half(counts: Column) -> Column:
        return F.coalesce(counts.bitwiseAND(F.lit((1 << 32) - 1)), F.lit(0).cast("long"))

    def high_half(counts: Column) -> Column:
        return F.coalesce(F.shiftright(counts, 32), F.lit(0).cast("long"))

    fit = F.count(c) - low_half(apart) - high_half(apart) - low_half(others) - high_half(others)
    finite = far & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return [F.sum(high_part(c)).alias(f"{name}_high"), F.sum(low_part(c)).alias(f"{name}_low"), fit.alias(f"{name}_fit"),
            low_half(apart).alias(f"{name}_nan"), high_half(apart).alias(f"{name}_up"),
            low_half(others).alias(f"{name}_down"), high_half(others).alias(f"{name}_beyond"),
            F.sum(F.when(finite, c)).alias(f"{name}_far")]


def parts_count(name: str) -> Column:
    """How many amounts ``sum_parts`` has seen, nulls aside."""
    return sum((F.col(f"{name}_{k}") for k in ("nan", "up", "down", "beyond")), F.col(f"{name}_fit"))


def of_parts(name: str, plain: Column, double: Column) -> Column:
    """A result from ``sum_parts``: ``plain`` if every amount was below ``BIG``, else ``double``, which is given
    the sum as a double (``parts_total``); NaN and infinities show as in double arithmetic."""
    nan, up, down = (F.col(f"{name}_{k}") > 0 for k in ("nan", "up", "down"))
    return (F.when(nan | (up & down), F.lit(float("nan")))
             .when(up, F.lit(float("inf"))).when(down, F.lit(float("-inf")))
             .when((F.col(f"{name}_beyond") == 0) & (F.col(f"{name}_high") == 0), plain)
             .otherwise(double))


def parts_total(name: str) -> Column:
    """The sum of ``sum_parts`` as a double: exact parts, each rounded once."""
    high = F.col(f"{name}_high").cast("double") * F.lit(UNIT)
    return high + F.col(f"{name}_low").cast("double") + F.coalesce(F.col(f"{name}_far"), F.lit(0.0))


def parts_sum2(name: str) -> Column:
    """ROUND(SUM(x), 2) from ``sum_parts``; null without amounts."""
    value = of_parts(name, sum2(f"{name}_low"), round2(parts_total(name)))
    return F.when(parts_count(name) > 0, value)


def parts_mean2(name: str) -> Column:
    """ROUND(AVG(x), 2) from ``sum_parts``; null without amounts."""
    n = parts_count(name)
    value = of_parts(name, mean2(F.col(f"{name}_low").cast("decimal(36,9)"), n), round2(parts_total(name) / n))
    return F.when(n > 0, value)


def mean2(total: str | Column, n: str | Column) -> Column:
    """Mean rounded to 2 decimals from an exact decimal sum.

    The sum in hundredths is exact, so the division is the only rounding
    before the last one, and means that are exactly half a cent round the same
    way on every engine and every partitioning.
    """
    return F.round((col(total) * F.lit(100)).cast("double") / col(n)) / F.lit(100.0)


def sum2(total: str | Column) -> Column:
    """An exact decimal sum rounded to 2 decimals, as a double."""
    return F.round(col(total), 2).cast("double")


def nan_to_null(x: str | Column) -> Column:
    """NaN counts as missing, as in a pandas numeric column."""
    return F.nanvl(col(x), F.lit(None).cast("double"))


def parse_number(x: str | Column, source_type: T.DataType) -> Column:
    """Lenient numeric parse: text or number in, double out, junk -> null."""
    c = col(x)
    if not isinstance(source_type, T.DoubleType):
        c = c.try_cast("double")
    return nan_to_null(c)


def parse_timestamp(x: str | Column, source_type: T.DataType) -> Column:
    """Lenient timestamp parse to wall-clock time; unparseable -> null."""
    c = col(x)
    if isinstance(source_type, T.TimestampNTZType):
        return c
    if isinstance(source_type, T.TimestampType):
        return c.cast("timestamp_ntz")
    if isinstance(source_type, T.LongType):
        # INT64 nanosecond timestamps read with spark.sql.legacy.parquet.nanosAsLong
        return F.timestamp_micros(F.floor(c / 1000)).cast("timestamp_ntz")
    if isinstance(source_type, T.DateType):
        return c.cast("timestamp_ntz")
    return c.cast("string").try_cast("timestamp_ntz")


def whole_number(x: str | Column) -> Column:
    """Truncate toward zero to a long; NaN or out of range -> null."""
    return col(x).try_cast("long")


def payment_label(code: str | Column) -> Column:
    """Payment code -> label; other, fractional or missing codes -> unknown."""
    c = col(code)
    expr = None
    for number, label in PAYMENT_LABELS.items():
        expr = (F.when(c == F.lit(float(number)), F.lit(label)) if expr is None
                else expr.when(c == F.lit(float(number)), F.lit(label)))
    return expr.otherwise(F.lit(UNKNOWN_PAYMENT))


def ts_text(ts: str | Column) -> Column:
    """Fixed-width text of a wall-clock timestamp, microsecond precision."""
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_utc(ts: str | Column) -> Column:
    """ISO-8601 text with a Z suffix; fraction only when it is not zero."""
    t = col(ts)
    frac = F.date_format(t, "SSSSSS")
    return F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("Z"),
    )


def parse_iso_utc(x: str | Column) -> Column:
    """ISO text (with Z or an offset) -> UTC wall-clock timestamp.

    The text is read as an instant and rendered as UTC wall time, so offsets
    are honoured. Needs the session time zone to be UTC (see session.py).
    """
    return col(x).try_cast("timestamp").cast("timestamp_ntz")


def as_ingest_time(x: str | Column, source_type: T.DataType) -> Column:
    """Ingest time of any stored type -> UTC wall-clock timestamp."""
    if isinstance(source_type, T.StringType):
        return parse_iso_utc(x)
    if isinstance(source_type, T.TimestampNTZType):
        return col(x)
    return col(x).cast("timestamp_ntz")


def batch_key(batch_id: str | Column) -> Column:
    """File-safe form of a batch id, different for different ids.

    ASCII letters, digits, ``-`` and ``_`` stay; every other byte of the UTF-8
    text becomes ``~`` and its two hex digits. The empty id is a lone ``~``.
    """
    b = col(batch_id)
    written = F.url_encode(b)
    # what URL encoding writes in its own way: "+" for a space, and "*" and "." as they are
    for mark, code in (("+", "%20"), ("*", "%2A"), (".", "%2E"), ("%", "~")):
        written = F.replace(written, F.lit(mark), F.lit(code))
    return F.when(b == "", F.lit("~")).otherwise(written)


def batch_key_text(batch_id: str) -> str:
    """The same rule as ``batch_key`` for one id known on the driver."""
    return quote(batch_id, safe="").replace(".", "%2E").replace("~", "%7E").replace("%", "~") or "~"


def _id_part(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NULL_TOKEN))


def trip_identity(pickup: Column, dropoff: Column, pickup_zone: Column, dropoff_zone: Column,
                  fare: Column, total: Column, vendor: Column) -> Column:
    """Content-derived trip id ``tlc_<md5>``.

    The text is built from the row alone: timestamps at microsecond precision,
    zones and vendor as whole numbers, fare and total in whole cents, and a
    fixed token for a missing field. Equal trips get equal ids in any batch.
    """
    text = F.concat_ws(
        "|",
        F.coalesce(ts_text(pickup), F.lit(NULL_TOKEN)),
        F.coalesce(ts_text(dropoff), F.lit(NULL_TOKEN)),
        _id_part(whole_number(pickup_zone)),
        _id_part(whole_number(dropoff_zone)),
        _id_part(cents(fare)),
        _id_part(cents(total)),
        _id_part(whole_number(vendor)),
    )
    return F.concat(F.lit(TRIP_ID_PREFIX), F.md5(text))
