"""Running balance of each cash point, maintained from a stream of moves.

The batch query ``e69_running_balance`` computes, for every point and every
day with operations, the balance at the end of that day.  As a stream:

* every micro-batch is reduced to one row per (point, day) -- an ordinary
  grouped aggregate with map-side combine, so the work is distributed no
  matter how many moves arrive for one point;
* days are kept "open" while rows for them may still arrive (``late_days``
  behind the newest day seen); once a day is older it is final: it is
  emitted with the point's carried balance plus the running sum of the
  finished days, and folded into that balance;
* late rows for already finished days change no balance, as with a
  watermark; they are kept apart, one folder a batch under ``late``, where
  ``late_moves`` reads them.

The state is tiny (open days per point and one balance per point) and is
written per batch id under ``state`` next to the output, so a retried batch
rewrites the same files (idempotent) and a restarted query resumes from the
last committed batch through its own checkpoint location.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathom.functions import dialect
from fathom.streaming.ledger import cash_moves

MONEY = "decimal(38,2)"
OPEN_SCHEMA = "point int, date date, rev decimal(38,2)"
BALANCE_SCHEMA = "point int, balance decimal(38,2)"
META_SCHEMA = "newest date, cut date"
LATE_SCHEMA = "point int, ts timestamp, rev decimal(38,2)"


def _read(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _meta(spark: SparkSession, prev_state: str | None):
    """(newest day, cut) after the batch before; NULLs where there was none."""
    rows = _read(spark, prev_state and f"{prev_state}/meta", META_SCHEMA).collect()
    return (rows[0].newest, rows[0].cut) if rows else (None, None)


def late(spark: SparkSession, moves: DataFrame, prev_state: str | None) -> DataFrame:
    """The moves of a batch that ``advance`` leaves out: their day was finished before, or they have none."""
    cut = _meta(spark, prev_state)[1]
    undated = F.col("ts").isNull()
    return moves.filter(undated if cut is None else undated | (F.to_date("ts") < F.lit(cut)))


def late_moves(spark: SparkSession, sink: str) -> DataFrame:
    """All moves kept apart as late so far: point, ts, rev and the batch they came with."""
    return spark.read.schema(LATE_SCHEMA + ", batch long").parquet(f"{sink}/late")


def advance(spark: SparkSession, moves: DataFrame, prev_state: str | None, late_days: int):
    """One step: (finished-day rows, new open days, new balances, new meta)."""
    opened = _read(spark, prev_state and f"{prev_state}/open", OPEN_SCHEMA)
    balances = _read(spark, prev_state and f"{prev_state}/balance", BALANCE_SCHEMA)
    old_newest, old_cut = _meta(spark, prev_state)

    daily = moves.groupBy("point", F.to_date("ts").alias("date")).agg(F.sum("rev").cast(MONEY).alias("rev"))
    if old_cut is not None:
        daily = daily.filter(F.col("date") >= F.lit(old_cut))
    merged = opened.unionByName(daily).groupBy("point", "date").agg(F.sum("rev").cast(MONEY).alias("rev"))

    newest_in_batch = daily.agg(F.max("date")).collect()[0][0]
    newest = max([d for d in (old_newest, newest_in_batch) if d is not None], default=None)
    cut = newest - dt.timedelta(days=late_days) if newest is not None else None
    if cut is None:
        return None, merged, balances, _read(spark, None, META_SCHEMA)
    finished = merged.filter(F.col("date") < F.lit(cut))
    still_open = merged.filter(F.col("date") >= F.lit(cut))

    w = Window.partitionBy("point").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.coalesce(F.col("balance"), F.lit(0).cast(MONEY))
    # A day whose own total is NULL (only NULL amounts so far) still reports
    # the balance carried into it, as the batch window does.
    emitted = finished.join(balances, "point", "left").select(
        "point",
        dialect.day_text(F.col("date")).alias("day"),
        "date",
        (carried + F.coalesce(F.sum("rev").over(w), F.lit(0).cast(MONEY))).cast(MONEY).alias("balance"),
        F.col("balance").isNull().alias("__fresh"),
        F.sum("rev").over(w).isNull().alias("__none"),
    )
    emitted = emitted.select(
        "point", "day", "date",
        F.when(F.col("__fresh") & F.col("__none"), F.lit(None).cast(MONEY)).otherwise(F.col("balance")).alias("balance"),
    )
    totals = finished.groupBy("point").agg(F.sum("rev").alias("add"))
    new_bal = balances.join(totals, "point", "full").select(
        "point",
        F.when(F.col("balance").isNull() & F.col("add").isNull(), F.lit(None).cast(MONEY))
        .otherwise(F.coalesce("balance", F.lit(0)) + F.coalesce("add", F.lit(0)))
        .cast(MONEY)
        .alias("balance"),
    )
    new_meta = spark.createDataFrame([(newest, cut)], META_SCHEMA)
    return emitted, still_open, new_bal, new_meta


def start_running_balance(
    spark: SparkSession,
    root: str,
    sink: str,
    checkpoint: str,
    late_days: int = 2,
    available_now: bool = False,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Stream end-of-day balances (point, day, date, balance) into Parquet under
    ``sink``; state lives in ``sink``/_state, late moves in ``sink``/late.
    Both paths must be on shared storage on a cluster."""
    state_root = f"{sink}/_state"
    moves = cash_moves(spark, root).select(
        "point", "ts", F.coalesce(F.col("inc"), -F.col("out")).alias("rev")
    )

    def step(batch: DataFrame, batch_id: int) -> None:
        # Micro-batch ids are consecutive and batch N runs only after N-1
        # committed, so the state to continue from is always N-1's.  A retried
        # batch rereads N-1 and overwrites its own files: idempotent.
        prev = f"{state_root}/batch={batch_id - 1}" if batch_id > 0 else None
        # Several actions read this batch (newest day, five writes): keep it
        # for the duration of the step instead of re-reading the source.
        batch.persist()
        try:
            emitted, still_open, balances, meta = advance(batch.sparkSession, batch, prev, late_days)
            here = f"{state_root}/batch={batch_id}"
            still_open.write.mode("overwrite").parquet(f"{here}/open")
            balances.write.mode("overwrite").parquet(f"{here}/balance")
            meta.write.mode("overwrite").parquet(f"{here}/meta")
            # Each column by the schema's type, so that all batches' files agree.
            kept = late(batch.sparkSession, batch, prev).select(
                F.col("point").cast("int"), "ts", F.col("rev").cast(MONEY)
            )
            kept.write.mode("overwrite").parquet(f"{sink}/late/batch={batch_id}")
            if emitted is not None:
                emitted.write.mode("overwrite").parquet(f"{sink}/days/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = moves.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
