"""Registry of named queries and their DuckDB oracle statements."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from faresight.session import apply_job_conf

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    build: QueryFn
    oracle: str | None
    covers: str


_REGISTRY: dict[str, Registered] = {}


def register(name: str, oracle: str | None = None, covers: str = "") -> Callable[[QueryFn], QueryFn]:
    """Register a query; it always runs with the job's session settings (UTC)."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")

        @functools.wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_job_conf(spark)
            return fn(spark, sf_dir)

        _REGISTRY[name] = Registered(name, build, oracle, covers)
        return fn
    return wrap


def registered() -> dict[str, Registered]:
    # Import for the side effect of registering every query module.
    from faresight.plans import queries  # noqa: F401
    return dict(_REGISTRY)
