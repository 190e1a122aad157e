"""Registry of named queries: a Spark builder and (when SQL can express it) an oracle."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def _in_utc(fn: QueryFn) -> QueryFn:
    """Hours and calendar parts are defined in UTC: pin the session zone first."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = _in_utc(fn)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from livepulse.plans import (  # noqa: F401
        q_bronze_silver, q_broadcasts, q_catalogue, q_gold, q_quality, q_semantic, q_streaming, q_transitions)
