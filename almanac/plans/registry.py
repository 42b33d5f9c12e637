"""Names of the queries, their functions and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of a session and a table folder, with equivalent SQL where SQL can say it."""

    def register(function: Query) -> Query:
        _QUERIES[name] = function
        if sql is not None:
            _ORACLES[name] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
