"""Queries over the given tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Named queries and the SQL to check them with."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None, name: str | None = None):
        """Register a function under its own name (or ``name``) with its SQL."""

        def register(function: Query) -> Query:
            key = name or function.__name__
            if key in self.queries:
                raise ValueError(f"query {key} exists already")
            self.queries[key] = function
            if sql is not None:
                self.oracles[key] = sql
            return function

        return register


CATALOG = Catalog()
query = CATALOG.query


def load() -> Catalog:
    """The catalog with all plan modules registered."""
    from clicklake.plans import enrichment, files, profiles, relational, scalars, sessions, visits  # noqa: F401

    return CATALOG
