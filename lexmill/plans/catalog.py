"""Registry of the queries: name -> (DataFrame function, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that checks it."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        if key in _queries:
            raise ValueError(f"two queries named {key}")
        _queries[key] = f
        if sql:
            _sql[key] = sql
        return f

    return add


def _load() -> None:
    from lexmill.plans import chain, corpus, crawl, curation, dedup, derived, evaluation, further, quality, relational, streams  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
