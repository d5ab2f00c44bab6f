"""Query registry.

A query is a function ``Views -> DataFrame`` plus, where the semantics are
plain SQL, the same question written as SQL over the domain views.  The SQL
is an independent formulation (it is what the checker runs on another
engine); the DataFrame version is the one tuned for Spark.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fathom.sources.sql_views import with_views
from fathom.sources.views import Views


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Views], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}

_MODULES = ("computers", "ships", "cash", "flights", "metrics")


def query(key: str, sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` under ``key`` with its SQL twin."""

    def wrap(fn: Callable[[Views], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return wrap


def load_all() -> dict[str, Query]:
    for mod in _MODULES:
        importlib.import_module(f"fathom.plans.{mod}")
    return REGISTRY


def run(spark: SparkSession, root: str, key: str) -> DataFrame:
    return load_all()[key].build(Views(spark, root))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reg = load_all()

    def bind(q: Query):
        def call(spark: SparkSession, root: str) -> DataFrame:
            return q.build(Views(spark, root))

        call.__name__ = q.key
        call.__doc__ = q.doc
        return call

    return {k: bind(q) for k, q in reg.items()}


def oracle_sql() -> dict[str, str]:
    return {k: with_views(q.sql) for k, q in load_all().items() if q.sql}
