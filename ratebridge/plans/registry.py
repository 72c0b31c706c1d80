"""Registry of queries: (spark, sf_dir) -> DataFrame, each optionally with oracle SQL.

Query outputs alias every computed column and cast DECIMAL results to DOUBLE
(engines disagree on the precision of ``round(decimal)``) and ages to INT, so
the Spark result and the SQL result compare value for value. The library
functions themselves keep the model types (DECIMAL(10,4) rates).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    """Register ``fn`` under ``name``; ``sql`` is its oracle (None: no SQL form)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _double(*names: str) -> list:
    return [F.col(n).cast("double").alias(n) for n in names]


def _sql_double(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)
