"""Registry of named queries and their DuckDB oracle SQL.

A query is a function ``(spark, sf_dir) -> DataFrame`` over the parquet tables
in ``sf_dir``. Its oracle is an SQL text over the same tables, registered as
views of the same names, that must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}
_NOTES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, covers: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        _NOTES[name] = covers
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return {name: _shipping(fn) for name, fn in _QUERIES.items()}


def _shipping(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tidemark.session import ship_package
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def notes() -> dict[str, str]:
    _load()
    return dict(_NOTES)


def _load() -> None:
    # Importing the modules registers their queries.
    from tidemark.plans import batch, streamed  # noqa: F401
