"""Registered queries: key -> (Spark builder, DuckDB oracle text or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables at that scale factor; nothing is collected. Oracle texts run on
DuckDB over the same parquet files with the adapter views prepended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if oracle is not None:
            _ORACLES[key] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # Importing the modules registers their queries.
    from . import q_ingest, q_metrics, q_profile, q_tpy  # noqa: F401
