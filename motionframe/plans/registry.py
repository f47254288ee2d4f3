"""Queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from motionframe.session import ship

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        self.queries[name] = run
        if sql is not None:
            self.sql[name] = sql
