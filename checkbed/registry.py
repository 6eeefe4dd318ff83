"""Registry of checked queries: a Spark callable and, next to it, its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.session import tune

from .bridge import Bridge
from .oracle import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, build: Callable[[Bridge], DataFrame], sql: str) -> None:
    """Register a query built from the bridge frames, with its oracle SQL."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return build(Bridge(spark, sf_dir))

    QUERIES[name] = run
    ORACLES[name] = oracle(sql)
