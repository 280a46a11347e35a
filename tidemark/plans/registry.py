"""Named queries over the test tables, each with its SQL for a second engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Family:
    """A group of queries registered together."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(function: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name!r} registered twice")
            self.queries[name] = function
            if sql is not None:
                self.oracles[name] = sql
            return function

        return register
