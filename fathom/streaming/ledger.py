"""Cash ledgers as a stream.

New orders and line items arrive as Parquet files.  Each stream is joined to
its (static) dimension -- customers for income, suppliers for outgo -- the
two are unioned into one stream of moves, and the daily per-point totals
(the batch query ``e30_ledger_sum``) are maintained with an event-time
watermark, so state holds only the days that can still receive late rows and
each finished day is emitted exactly once (append mode).  Sinks write
Parquet with a checkpoint location, which makes the job restartable after
executor or driver loss without duplicating output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathom.sources.tables import read_table, table_path

MONEY = "decimal(18,2)"


def table_stream(spark: SparkSession, root: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of one table (a directory, or a single file in ``root``).

    The schema is taken from the existing data, never inferred per batch.
    """
    schema = read_table(spark, root, name).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    path = table_path(root, name)
    if os.path.isdir(path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", os.path.basename(path)).parquet(root)


def cash_moves(spark: SparkSession, root: str) -> DataFrame:
    """Streaming (point, ts, inc, out): income rows with NULL outgo and the
    reverse, as in the padded union of the batch ledgers; ``ts`` is the start
    of the day of the move."""
    orders = table_stream(spark, root, "orders").filter(F.col("o_orderstatus") == "F")
    customers = read_table(spark, root, "customer").filter(F.col("c_nationkey") != 3)
    income = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("c_nationkey").alias("point"),
        F.to_date("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").cast(MONEY).alias("inc"),
        F.lit(None).cast(MONEY).alias("out"),
    )
    items = table_stream(spark, root, "lineitem").filter(F.col("l_returnflag") == "R")
    suppliers = read_table(spark, root, "supplier").filter(F.col("s_nationkey") != 7)
    outgo = items.join(suppliers, items.l_suppkey == suppliers.s_suppkey).select(
        F.col("s_nationkey").alias("point"),
        F.to_date("l_shipdate").cast("timestamp").alias("ts"),
        F.lit(None).cast(MONEY).alias("inc"),
        F.col("l_extendedprice").cast(MONEY).alias("out"),
    )
    return income.unionByName(outgo)


def daily_ledger(moves: DataFrame, late: str = "2 days") -> DataFrame:
    """Per point and day: total outgo and income (NULL when absent).

    Rows later than ``late`` behind the newest event are dropped by the
    watermark; a day is emitted once the watermark has passed its end.
    """
    # ``ts`` is the start of the move's day (local midnight of the session
    # time zone), so grouping by the event-time column itself groups by day
    # in any time zone -- no epoch-aligned window involved.
    days = moves.withWatermark("ts", late).groupBy("point", "ts")
    totals = days.agg(F.sum("out").alias("out"), F.sum("inc").alias("inc"))
    return totals.select(
        "point",
        F.to_date("ts").alias("date"),
        F.col("out").cast("decimal(38,2)").alias("out"),
        F.col("inc").cast("decimal(38,2)").alias("inc"),
    )


def dropped_as_late(query: StreamingQuery) -> int:
    """How many (point, day) totals the watermark has dropped in the batches that ``query`` still reports.

    Counted by Spark before a batch's rows meet the state, so a day's late
    rows of one batch and task count once.  ``recentProgress`` holds the last
    ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def start_daily_ledger(
    spark: SparkSession,
    root: str,
    sink: str,
    checkpoint: str,
    late: str = "2 days",
    available_now: bool = False,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Run the daily ledger into Parquet files under ``sink``.

    ``checkpoint`` must be on shared, reliable storage (the same kind of
    location as ``spark.checkpoint.dir``), so a restarted query resumes from
    its last committed batch.
    """
    writer = (
        daily_ledger(cash_moves(spark, root), late)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
