"""Quantified comparisons (``op ALL (subquery)``) without a cross join.

Spark SQL has no ``ALL``/``ANY``.  ``x < ALL (S)`` is TRUE when S is empty,
and otherwise TRUE only when S holds no NULL and ``x < min(S)``.  The three
numbers come from one aggregate of S, evaluated once as a scalar subquery and
shipped to every task as a constant -- no join at all.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {
    "<": (operator.lt, F.min),
    "<=": (operator.le, F.min),
    ">": (operator.gt, F.max),
    ">=": (operator.ge, F.max),
}


def all_predicate(value: Column, op: str, sub: DataFrame, sub_col: str) -> Column:
    """Boolean column for ``value <op> ALL (SELECT sub_col FROM sub)``."""
    compare, extreme = _OPS[op]
    stats = sub.agg(
        F.struct(
            extreme(sub_col).alias("bound"),
            F.count(F.lit(1)).alias("n"),
            F.count(sub_col).alias("nn"),
        )
    ).scalar()
    return (stats["n"] == 0) | ((stats["nn"] == stats["n"]) & compare(value, stats["bound"]))


def filter_all(df: DataFrame, value: Column, op: str, sub: DataFrame, sub_col: str) -> DataFrame:
    return df.filter(all_predicate(value, op, sub, sub_col))
