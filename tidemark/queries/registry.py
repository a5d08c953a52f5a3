"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.queries.oracle import with_views
from tidemark.sources.fixture import Fixture


@dataclass(frozen=True)
class Query:
    build: Callable[[Fixture], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, directory: str) -> DataFrame:
        return self.build(Fixture(spark, directory))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query. ``views`` names the fixture views its SQL reads."""

    def register(build: Callable[[Fixture], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(build, with_views(views, sql) if sql else None)
        return build

    return register
