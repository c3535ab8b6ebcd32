"""Threshold-based data quality checks.

An expectation is ``(name, failing-row condition or key columns, max_failures)``
and applies to any DataFrame. All row-level conditions of a report are counted
in one aggregate (one scan, partial aggregation per task); each key check is a
grouped count with map-side combine, so a key holding many copies is reduced
before the shuffle. The report is a small DataFrame with one row per check.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faresight.schemas import QUALITY_REPORT_SCHEMA
from faresight.session import read_text, write_text

REPORT_FILE = "report.json"


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: Column | None = None          # rows matching it are failures
    unique_key: tuple[str, ...] | None = None  # keys occurring more than once are failures
    max_failures: int = 0
    ignore_null_keys: bool = False           # unique test: null keys do not count

    def __post_init__(self) -> None:
        if (self.condition is None) == (self.unique_key is None):
            raise ValueError("an expectation has either a condition or a unique key")


def silver_expectations(max_failures: dict[str, int] | None = None) -> list[Expectation]:
    """The eight checks run on silver, in report order."""
    limits = max_failures or {}
    c = F.col
    checks = [
        Expectation("null_pickup_datetime", c("pickup_datetime").isNull()),
        Expectation("null_dropoff_datetime", c("dropoff_datetime").isNull()),
        Expectation("non_positive_distance", c("trip_distance") <= 0),
        Expectation("non_positive_fare", c("fare_amount") <= 0),
        Expectation("invalid_passenger_count", (c("passenger_count") < 1) | (c("passenger_count") > 6)),
        Expectation("duplicate_trip_id", unique_key=("trip_id",)),
        Expectation("invalid_trip_duration",
                    (c("trip_duration_min") <= 0) | (c("trip_duration_min") > 180)),
        Expectation("total_amount_below_fare", c("total_amount") < c("fare_amount")),
    ]
    return [Expectation(e.name, e.condition, e.unique_key, limits.get(e.name, e.max_failures),
                        e.ignore_null_keys) for e in checks]


def not_null_tests(columns: Sequence[str], prefix: str = "not_null") -> list[Expectation]:
    return [Expectation(f"{prefix}_{col}", F.col(col).isNull()) for col in columns]


def unique_test(columns: Sequence[str], prefix: str = "unique") -> Expectation:
    return Expectation(f"{prefix}_{'_'.join(columns)}", unique_key=tuple(columns),
                       ignore_null_keys=True)


def duplicate_key_count(df: DataFrame, keys: Sequence[str], ignore_null_keys: bool = False) -> DataFrame:
    """One row: number of keys occurring more than once (``HAVING COUNT(*) > 1``)."""
    src = df.select(*keys)
    if ignore_null_keys:
        src = src.dropna(how="any", subset=list(keys))
    return (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
               .agg(F.count_if(F.col("_n") > 1).alias("failures")))


def row_check_metrics(expectations: Sequence[Expectation]) -> list[Column]:
    """One ``count_if`` per row-level expectation, named ``c<position>``.

    Usable in an aggregate or in an ``observe`` on a write, so the checks can
    be counted while the data is being written instead of by another scan.
    """
    return [F.count_if(e.condition).alias(f"c{i}")
            for i, e in enumerate(expectations, 1) if e.condition is not None]


def quality_report(df: DataFrame, expectations: Sequence[Expectation],
                   known: Mapping[int, int] | None = None) -> DataFrame:
    """``check_order, name, failures, max_failures, passed`` per expectation.

    ``known`` gives failures already counted for some checks, by position
    (1-based): counted while the data was written, or maintained from the
    previous report. Only the other checks read ``df``.
    """
    known = dict(known or {})
    numbered = list(enumerate(expectations, 1))
    row_checks = [(i, e) for i, e in numbered if e.condition is not None and i not in known]
    key_checks = [(i, e) for i, e in numbered if e.unique_key is not None and i not in known]
    given = [(i, e) for i, e in numbered if i in known]
    parts: list[DataFrame] = []

    def stacked(source: DataFrame, checks, failures) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(i).alias("check_order"), F.lit(e.name).alias("name"),
                                  failures(i).cast("long").alias("failures"),
                                  F.lit(e.max_failures).cast("long").alias("max_failures"))
                         for i, e in checks])
        return source.select(F.inline(rows))

    if given:
        parts.append(stacked(df.sparkSession.range(1), given, lambda i: F.lit(int(known[i]))))
    if row_checks:
        counts = df.agg(*[F.count_if(e.condition).alias(f"c{i}") for i, e in row_checks])
        parts.append(stacked(counts, row_checks, lambda i: F.col(f"c{i}")))
    for i, e in key_checks:
        parts.append(duplicate_key_count(df, e.unique_key, e.ignore_null_keys).select(
            F.lit(i).alias("check_order"), F.lit(e.name).alias("name"), "failures",
            F.lit(e.max_failures).cast("long").alias("max_failures")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(
        F.col("check_order").cast("int"), "name", F.col("failures").cast("long"), "max_failures",
        (F.col("failures") <= F.col("max_failures")).alias("passed"),
    ).select(*QUALITY_REPORT_SCHEMA.fieldNames())


def report_in_one_pass(df: DataFrame, expectations: Sequence[Expectation], keys: Sequence[str]) -> DataFrame:
    """``quality_report`` over rows carrying ``with_key_copies`` columns for ``keys``, as one
    aggregate of one scan; unique-key checks have to be on exactly ``keys``."""
    numbered = list(enumerate(expectations, 1))
    other = [e.name for _, e in numbered if e.unique_key is not None and tuple(e.unique_key) != tuple(keys)]
    if other:
        raise ValueError(f"checks on other keys than {tuple(keys)}: {other}")
    counts = df.agg(*row_check_metrics(expectations), *key_check_metrics(expectations, keys))
    rows = F.array(*[F.struct(F.lit(i).cast("int").alias("check_order"), F.lit(e.name).alias("name"),
                              F.col(f"{'c' if e.unique_key is None else 'k'}{i}").cast("long").alias("failures"),
                              F.lit(e.max_failures).cast("long").alias("max_failures")) for i, e in numbered])
    return (counts.select(F.inline(rows)).withColumn("passed", F.col("failures") <= F.col("max_failures"))
            .select(*QUALITY_REPORT_SCHEMA.fieldNames()))


COPIES_COL, FIRST_COL = "_key_copies", "_key_first"


def with_key_copies(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Each row with the number of rows sharing its key, and a flag on one row per key.

    Meant for data already partitioned by ``keys`` and sorted by ``keys`` then
    ``order`` (the output of a newest-per-key window with that order): then
    these window columns need no new exchange and no new sort, and
    ``key_check_metrics`` can count duplicated keys while the rows are written.
    """
    by_key = Window.partitionBy(*keys).orderBy(*(list(order) or keys))
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({
        COPIES_COL: F.count(F.lit(1)).over(whole),
        FIRST_COL: F.row_number().over(by_key) == 1,
    })


def key_check_metrics(expectations: Sequence[Expectation], keys: Sequence[str]) -> list[Column]:
    """For unique-key checks on exactly ``keys``: keys occurring more than once,
    named ``k<position>``, over rows carrying ``with_key_copies`` columns."""
    out = []
    for i, e in enumerate(expectations, 1):
        if e.unique_key is None or tuple(e.unique_key) != tuple(keys):
            continue
        duplicated = (F.col(COPIES_COL) > 1) & F.col(FIRST_COL)
        if e.ignore_null_keys:
            for k in keys:
                duplicated = duplicated & F.col(k).isNotNull()
        out.append(F.count_if(duplicated).alias(f"k{i}"))
    return out


def observed_failures(observed: Mapping[str, int]) -> dict[int, int]:
    """Observed check metrics (``c<position>``, ``k<position>``) as failures by position."""
    return {int(k[1:]): int(v) for k, v in observed.items()
            if k[:1] in ("c", "k") and k[1:].isdigit()}


def count_failures(df: DataFrame, expectations: Sequence[Expectation]) -> dict[int, int]:
    """Failures of every check over ``df``, by position (a small collect)."""
    return {r["check_order"]: int(r["failures"])
            for r in quality_report(df, expectations).select("check_order", "failures").collect()}


def stored_failures(spark, report_dir: str, expectations: Sequence[Expectation]) -> dict[int, int] | None:
    """Failures by position from a report written by ``evaluate``; None when the
    report is absent or was written for another list of checks."""
    text = read_text(spark, f"{report_dir.rstrip('/')}/{REPORT_FILE}")
    if text is None:
        return None
    rows = [json.loads(line) for line in text.splitlines() if line.strip()]
    by_order = {int(r["check_order"]): r for r in rows}
    wanted = {i: e.name for i, e in enumerate(expectations, 1)}
    if {i: r["name"] for i, r in by_order.items()} != wanted:
        return None
    return {i: int(r["failures"]) for i, r in by_order.items()}


def quality_summary(report: DataFrame) -> DataFrame:
    """Checks passed, checks failed and the overall verdict, as one row."""
    return report.agg(
        F.count_if(F.col("passed")).cast("int").alias("checks_passed"),
        F.count_if(~F.col("passed")).cast("int").alias("checks_failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("overall_pass"),
    )


class QualityGateError(ValueError):
    """Raised when a report has failed checks and the gate is enforced."""


@dataclass(frozen=True)
class QualityOutcome:
    overall_pass: bool
    checks: list[dict]

    @property
    def checks_passed(self) -> int:
        return sum(1 for c in self.checks if c["passed"])

    @property
    def checks_failed(self) -> int:
        return sum(1 for c in self.checks if not c["passed"])


def evaluate(report: DataFrame, report_dir: str | None = None,
             raise_on_failure: bool = True) -> QualityOutcome:
    """Compute the report once, optionally store it as JSON lines, then gate.

    The report has one row per check, so collecting it is bounded by the
    number of expectations, not by the data.
    """
    rows = [r.asDict() for r in report.orderBy("check_order").collect()]
    if report_dir is not None:
        # one JSON line per check, readable with spark.read.schema(QUALITY_REPORT_SCHEMA).json
        write_text(report.sparkSession, f"{report_dir.rstrip('/')}/{REPORT_FILE}",
                   "".join(json.dumps(r) + "\n" for r in rows))
    outcome = QualityOutcome(all(r["passed"] for r in rows), rows)
    if raise_on_failure and not outcome.overall_pass:
        failed = [r["name"] for r in rows if not r["passed"]]
        raise QualityGateError(f"Quality checks failed: {failed}")
    return outcome
