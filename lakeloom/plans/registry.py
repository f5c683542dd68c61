"""Registry of named queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeloom.session import tune
from lakeloom.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(tune(spark), folder))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` as a query, with its SQL statement."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, build, sql)
        return build

    return register
