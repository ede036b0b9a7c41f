"""All registered queries of the table-sync operators, each with its DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def registered(sql: str | None = None, columns: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name; `columns` picks columns of the SQL's result."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            text = with_fixtures(sql)
            _SQL[f.__name__] = f"SELECT {columns} FROM ({text}) result" if columns else text
        return f

    return add


def queries() -> dict[str, Query]:
    from . import queries_messages, queries_sync  # noqa: F401

    return dict(_QUERIES)


def sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
