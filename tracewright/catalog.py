"""Name -> query, and name -> SQL of the same result, over the bindings of ``plans.bindings``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    """Adds a query under its function's name, with the SQL that DuckDB answers alike."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


from tracewright import (  # noqa: E402, F401
    catalog_documents,
    catalog_graph,
    catalog_hub,
    catalog_notes,
    catalog_queue,
    catalog_records,
    catalog_register,
    catalog_repair,
    catalog_reports,
    catalog_rules,
    catalog_scores,
    catalog_stores,
    catalog_streams,
    catalog_text,
)
