"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Section:
    """Queries by name, with the SQL that must give the same rows where SQL can say it."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = query
            if sql is not None:
                self.oracles[name] = sql
            return query

        return add
