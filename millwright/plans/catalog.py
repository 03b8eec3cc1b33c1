"""Registry of named queries and their independent SQL oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables.  The
final projection rounds doubles to 6 places and drops the session zone from
timestamps, so values compare exactly with the oracle; nothing else changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.coerce import round_doubles
from ..session import apply_session_conf
from .oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra_ctes: str = ""):
    def deco(fn: Callable[[SparkSession, str], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_conf(spark)
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = with_views(sql, extra_ctes)
        return run

    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # Importing the modules registers their queries.
    from . import queries_core, queries_quality, queries_features, queries_readmodels  # noqa: F401
    from . import queries_flagship, queries_ingest, queries_ml, queries_stream, queries_daily  # noqa: F401
