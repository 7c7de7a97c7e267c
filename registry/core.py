"""The decorator that pairs a Spark query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from registry.inputs import Inputs
from registry.sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs)`` under ``name``; ``sql`` may use any view of ``registry.sql``."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return wrap
