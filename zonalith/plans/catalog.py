"""Registered queries of the core library, with the DuckDB SQL each is held against.

The measurement tables of production are bound to the test tables: cells to `lineitem`, series to `events`, the ledger
and land state to `orders`, parcels to `supplier`. Operators take column names, so a binding is a projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL it must equal."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


from zonalith.plans import cell_queries, driver_queries, geo_queries, more_queries, series_queries, state_queries  # noqa: E402, F401
