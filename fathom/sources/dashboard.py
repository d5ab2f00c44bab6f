"""Metric tables for dashboards, kept up to date a day at a time.

``refresh`` reads the events of the given days and replaces those days'
partitions and no others, so an append or a correction costs its own days.
The tables hold what can be merged (sums, counts, bitmaps of users), and
``report`` answers for any days and dimensions from them, without the events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators.distinct import id_bitmaps, merged_counts

_SUMS = "day date, event_type string, events long, valued long, total_value decimal(38,2)"
_USERS = "day date, event_type string, bucket long, ids binary"


def refresh(spark: SparkSession, events: DataFrame, folder: str, days: list[dt.date]) -> None:
    """Compute the given days anew from ``events`` and replace their partitions under ``folder``.

    ``folder``/sums and ``folder``/users are Parquet tables partitioned by
    day.  Running it again gives the same tables.  A day without events is
    replaced, too: every given day gets a row that counts nothing, which
    ``report`` leaves out.  NULL timestamps belong to no day.
    """
    if not days:
        return
    wanted = spark.createDataFrame([(d,) for d in sorted(set(days))], "day date")
    day = F.col("ts").cast("timestamp_ntz")
    first, after = min(days), max(days) + dt.timedelta(days=1)
    rows = events.filter((day >= F.lit(first).cast("timestamp_ntz")) & (day < F.lit(after).cast("timestamp_ntz"))).select(
        F.to_date(day).alias("day"), "event_type", "user_id", F.col("value").cast("decimal(18,2)").alias("value")
    )
    rows = rows.filter(F.col("day").isin(*set(days)))
    sums = rows.groupBy("day", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count("value").alias("valued"), F.sum("value").cast("decimal(38,2)").alias("total_value")
    )
    empty = wanted.select("day", F.lit(None).cast("string").alias("event_type"), F.lit(0).cast("long").alias("events"))
    _replace(sums.unionByName(empty, allowMissingColumns=True), f"{folder}/sums")
    users = id_bitmaps(rows, ["day", "event_type"], F.col("user_id"))
    _replace(users.unionByName(wanted, allowMissingColumns=True), f"{folder}/users")


def _replace(rows: DataFrame, path: str) -> None:
    # A file or a few per day, not one per day and task.
    rows = rows.repartition("day")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def report(spark: SparkSession, folder: str, by: list[str], first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """(by, events, users, total_value, avg_value) over the days from ``first`` to ``last``; ``by`` of day and event_type."""

    def table(schema: str, name: str, known: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(f"{folder}/{name}").filter(known)
        if first is not None:
            rows = rows.filter(F.col("day") >= F.lit(first))
        return rows if last is None else rows.filter(F.col("day") <= F.lit(last))

    sums = table(_SUMS, "sums", "events > 0").groupBy(*by).agg(
        F.sum("events").alias("events"), F.sum("valued").alias("valued"), F.sum("total_value").cast("decimal(38,2)").alias("total_value")
    )
    users = merged_counts(table(_USERS, "users", "ids IS NOT NULL"), by, "users")
    users = users.select(*[F.col(c).alias(f"_{c}") for c in by], "users")
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    both = sums.join(users, same, "left")
    mean = F.try_divide(F.col("total_value").cast("double"), F.col("valued"))
    return both.select(*by, "events", F.coalesce("users", F.lit(0)).alias("users"), "total_value", mean.alias("avg_value"))
