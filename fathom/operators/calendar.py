"""Calendar spines and gap filling (``generate_series`` + LEFT JOIN)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included.

    Built from ``spark.range`` over the day offsets, so a long spine is
    generated in parallel rather than exploded from one array in one task.
    """
    days = (end - start).days + 1
    if days < 0:
        days = 0
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def calendar_fill(spine: DataFrame, counts: DataFrame, key: str, value: str, default=0) -> DataFrame:
    """Every spine day with its value from ``counts`` (``default`` when absent)."""
    joined = spine.join(counts, key, "left")
    return joined.select(key, F.coalesce(F.col(value), F.lit(default)).alias(value))
