"""Names of all queries of the library, each with a Spark plan and, where SQL can say it, DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, tuple[Query, str | None]] = {}
MODULES = ["text_queries", "section_queries", "flow_queries", "message_queries", "progress_queries", "source_queries"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query and its DuckDB SQL."""

    def put(f: Query) -> Query:
        assert name not in FOUND, name
        FOUND[name] = f, sql
        return f

    return put


def loaded() -> dict[str, tuple[Query, str | None]]:
    for m in MODULES:
        import_module(f"bookflow.plans.{m}")
    return FOUND


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in loaded().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in loaded().items() if sql}
