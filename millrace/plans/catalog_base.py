"""A catalogue of named queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str) -> Callable[[Query], Query]:
        """Registers a query under its name, with its SQL."""

        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            self.sql[f.__name__] = sql
            return f

        return add
