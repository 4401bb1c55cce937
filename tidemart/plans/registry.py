"""Registry of runnable queries: each pairs a Spark query with its check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemart.plans.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of `Tables`; `sql` is its equivalent over the same tables."""

    def add(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql)
        return run

    return add
