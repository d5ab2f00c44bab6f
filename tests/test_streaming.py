"""The streaming daily ledger equals the batch ledger for finished days."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from fathom.plans.registry import run
from fathom.streaming import cash_moves, daily_ledger, start_daily_ledger

SF = "/root/testdata/sf0.001"


def test_streaming_daily_ledger_matches_batch(spark):
    scratch = tempfile.mkdtemp(prefix="fathom-stream-")
    stream = daily_ledger(cash_moves(spark, SF), late="2 days")
    q = (
        stream.writeStream.outputMode("append")
        .format("memory")
        .queryName("daily_ledger_test")
        .option("checkpointLocation", f"{scratch}/ck")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = {(r.point, r.date): (r.out, r.inc) for r in spark.table("daily_ledger_test").collect()}
    batch = run(spark, SF, "e30_ledger_sum").collect()
    want = {(r.point, r.date): (r.out, r.inc) for r in batch}
    newest = max(d for _, d in want)
    finished = {k: v for k, v in want.items() if k[1] < newest - dt.timedelta(days=3)}
    assert got, "no day was emitted"
    assert all(got[k] == want[k] for k in got), "emitted day differs from batch"
    assert set(finished) <= set(got), "a finished day was not emitted"


def test_streaming_ledger_to_parquet_sink(spark):
    scratch = tempfile.mkdtemp(prefix="fathom-stream-")
    q = start_daily_ledger(spark, SF, f"{scratch}/out", f"{scratch}/ck", available_now=True)
    q.awaitTermination(300)
    written = spark.read.parquet(f"{scratch}/out")
    assert written.count() > 0
    assert written.filter(F.col("inc").isNull() & F.col("out").isNull()).count() == 0


def test_streaming_running_balance_matches_batch(spark):
    from fathom.streaming import start_running_balance

    scratch = tempfile.mkdtemp(prefix="fathom-stream-")
    q = start_running_balance(spark, SF, f"{scratch}/out", f"{scratch}/ck", late_days=2, available_now=True)
    q.awaitTermination(300)
    got = {(r.point, r.day): r.balance for r in spark.read.parquet(f"{scratch}/out/days").collect()}
    batch = run(spark, SF, "e69_running_balance").collect()
    want = {(r.point, r.day): r.balance for r in batch}
    assert got, "no finished day was emitted"
    assert all(got[k] == want[k] for k in got), [(k, got[k], want[k]) for k in got if got[k] != want[k]][:3]
    days = {r.point: r for r in run(spark, SF, "e30_ledger_sum").collect()}
    assert len(got) >= len(want) - 3 * len(days)


def test_running_balance_steps_carry_state(spark):
    """Two micro-batches: the second continues from the state of the first,
    and a late row for a finished day is dropped."""
    from decimal import Decimal as M

    from fathom.streaming.balance import advance

    scratch = tempfile.mkdtemp(prefix="fathom-steps-")
    sch = "point int, ts timestamp, rev decimal(18,2)"
    b0 = spark.createDataFrame(
        [(1, dt.datetime(2001, 1, 1, 9), M("10.00")), (1, dt.datetime(2001, 1, 2, 9), M("-3.00")),
         (1, dt.datetime(2001, 1, 5, 9), M("1.00")), (2, dt.datetime(2001, 1, 1, 9), None)],
        sch,
    )
    emitted, still_open, bal, meta = advance(spark, b0, None, late_days=2)
    assert {(r.point, r.day, r.balance) for r in emitted.collect()} == {
        (1, "01/01/2001", M("10.00")), (1, "02/01/2001", M("7.00")), (2, "01/01/2001", None)
    }
    for name, df in (("open", still_open), ("balance", bal), ("meta", meta)):
        df.write.parquet(f"{scratch}/s0/{name}")
    b1 = spark.createDataFrame(
        [(1, dt.datetime(2001, 1, 8, 9), M("2.00")), (1, dt.datetime(2001, 1, 1, 12), M("100.00")),
         (2, dt.datetime(2001, 1, 6, 9), M("4.00"))],
        sch,
    )
    emitted, _, _, _ = advance(spark, b1, f"{scratch}/s0", late_days=2)
    # newest day 01-08, two days of lateness: days before 01-06 are final;
    # the late 100.00 for the finished 01-01 is dropped; 01-06 stays open.
    assert {(r.point, r.day, r.balance) for r in emitted.collect()} == {(1, "05/01/2001", M("8.00"))}


def _two_deliveries(spark, first, second):
    """A data folder whose orders come as two files, and a function that delivers the second."""
    root = tempfile.mkdtemp(prefix="fathom-late-")
    for name in ("customer", "supplier"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").limit(0).write.parquet(f"{root}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.filter(first).coalesce(1).write.parquet(f"{root}/orders.parquet")
    return root, lambda: orders.filter(second).coalesce(1).write.mode("append").parquet(f"{root}/orders.parquet")


def test_late_moves_are_kept_apart(spark):
    """Moves of finished days that come with a second file change no balance and lose no row."""
    from fathom.streaming import late_moves, start_running_balance

    old = F.year("o_orderdate") < 1997
    root, deliver = _two_deliveries(spark, ~old, old)
    sink, checkpoint = f"{root}/out", f"{root}/ck"

    def run_once():
        start_running_balance(spark, root, sink, checkpoint, late_days=2, available_now=True).awaitTermination(300)
        return {(r.point, r.day): r.balance for r in spark.read.parquet(f"{sink}/days").collect()}

    before = run_once()
    assert before and late_moves(spark, sink).count() == 0
    deliver()
    assert run_once() == before
    orders = spark.read.parquet(f"{SF}/orders.parquet").filter(old & (F.col("o_orderstatus") == "F"))
    points = spark.read.parquet(f"{SF}/customer.parquet").filter("c_nationkey != 3")
    missed = orders.join(points, F.col("o_custkey") == F.col("c_custkey"))
    want = missed.agg(F.count(F.lit(1)), F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).first()
    got = late_moves(spark, sink).agg(F.count(F.lit(1)), F.sum("rev"), F.min("batch"), F.max("batch")).first()
    assert want[0] > 0 and tuple(got) == (want[0], want[1], 1, 1)


def test_late_keeps_what_advance_leaves_out(spark):
    from decimal import Decimal as M

    from fathom.streaming.balance import advance, late

    scratch = tempfile.mkdtemp(prefix="fathom-late-")
    day = lambda d: dt.datetime(2001, 1, d, 9)
    moves = lambda *rows: spark.createDataFrame(rows, "point int, ts timestamp, rev decimal(18,2)")
    first = moves((1, day(1), M("1.00")), (1, day(9), M("2.00")), (1, None, M("4.00")))
    assert [r.rev for r in late(spark, first, None).collect()] == [M("4.00")]
    for name, df in zip(("open", "balance", "meta"), advance(spark, first, None, late_days=2)[1:]):
        df.write.parquet(f"{scratch}/s0/{name}")
    second = moves((1, day(6), M("8.00")), (1, day(7), M("16.00")), (None, day(1), None), (1, None, M("32.00")))
    kept = late(spark, second, f"{scratch}/s0").collect()
    assert {(r.point, r.ts, r.rev) for r in kept} == {(1, day(6), M("8.00")), (None, day(1), None), (1, None, M("32.00"))}


def test_dropped_totals_of_the_ledger_are_counted(spark):
    from fathom.streaming import dropped_as_late

    old = F.year("o_orderdate") < 1997
    root, deliver = _two_deliveries(spark, ~old, old)

    def run_once():
        q = start_daily_ledger(spark, root, f"{root}/out", f"{root}/ck", available_now=True)
        q.awaitTermination(300)
        return dropped_as_late(q)

    assert run_once() == 0
    deliver()
    assert run_once() > 0
