"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from padron.sources.registry import Registry, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of a Registry under an operator's name."""

    def wrap(f: Callable[[Registry], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: f(Registry(spark, sf_dir))
        if oracle:
            ORACLES[name] = with_views(oracle)
        return f

    return wrap
