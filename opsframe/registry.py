"""Registry of driver queries: name → (spark callable, oracle SQL or None).

Each driver module under ``opsframe.driver`` registers its queries with
``@query(name, oracle=SQL)``. The Spark callable takes ``(spark, sf_dir)`` and
returns a lazy DataFrame built from the role views (``opsframe.sources.roles``)
and library operators; the oracle is DuckDB SQL over the same parquet tables.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Queries need a session in UTC, as all control-table times are (``get_spark`` and ``__spark_entry__`` see to it).
QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}

DRIVER_MODULES = (
    "routing", "tables", "logs", "logfiles", "jobs", "inventory", "plans", "projectcfg", "streams",
)


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def _load() -> None:
    for m in DRIVER_MODULES:
        try:
            importlib.import_module(f"opsframe.driver.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"opsframe.driver.{m}":
                raise


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
