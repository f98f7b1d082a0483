"""Collecting queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, QueryFunction] = {}
        self.sql: dict[str, str | Callable[[], str | None]] = {}

    def query(self, name: str, sql: str | Callable[[], str | None] | None = None):
        """Register a function ``(spark, sf_dir) -> DataFrame`` under ``name``.

        ``sql`` is the text to compare with, or a function that makes it when asked.
        """

        def add(function: QueryFunction) -> QueryFunction:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return add


REGISTRY = Registry()
query = REGISTRY.query
