"""Every registered query against its DuckDB statement on the smallest data set."""

from __future__ import annotations

import os

import pytest

from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data not present")


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from faresight.plans.registry import registered
    assert set(registered()) <= set(E.queries())
    assert set(registered()) <= set(E.oracle_sql())


def test_queries_match_oracle(spark):
    from faresight.plans.registry import registered
    from tools.oracle_check import compare
    report = compare(spark, SF_SMALL, list(registered()))
    failures = {k: v for k, v in report.items() if v.get("ok") is False}
    assert not failures, failures
    assert all(v["rows"] >= 0 for v in report.values())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["pickup_date", "pickup_hour", "zone_id", "trip_count",
                          "avg_trip_distance", "avg_fare_amount", "total_revenue"]
    assert df.count() == 755
