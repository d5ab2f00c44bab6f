"""Ranks, prefix sums, mergeable distinct counts, pairs and dashboard tables against plain Python."""

import collections
import datetime as dt
import math
import os
import random
import re
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fathom.operators import pairs, ranks
from fathom.operators.distinct import id_bitmaps, merged_counts
from fathom.operators.windows import prefix_sums, running_total
from fathom.sources import dashboard

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ ranks
def average_ranks(values):
    order = sorted(values)
    first, last = {}, {}
    for i, v in enumerate(order, 1):
        first.setdefault(v, i)
        last[v] = i
    return {v: (first[v] + last[v]) / 2 for v in first}


def some_values(seed, n, spread):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), Decimal(rng.randint(0, spread)).scaleb(-2)) for _ in range(n)]
    return rows + [("a", None), ("b", None)] + [("a", Decimal("1.00"))] * (n // 3)


@pytest.mark.parametrize("n, spread, rows", [(40, 5, None), (3000, 900, 64), (2000, 10**6, 64), (1, 1, None)])
def test_ranks_and_rank_sums_by_sorting(spark, n, spread, rows):
    data = some_values(n, n, spread)
    df = spark.createDataFrame(data, "g string, v decimal(18,2)").repartition(5)
    known = [(g, v) for g, v in data if v is not None]
    rank = average_ranks([v for _, v in known])
    got = ranks.value_ranks(df, "v", "g", rows).collect()
    number = collections.Counter(known)
    assert {(r.g, r.v): (r.n, r.twice_rank / 2) for r in got} == {(g, v): (number[g, v], rank[v]) for g, v in number}
    sums = {r.g: r for r in ranks.rank_sums(df, "v", "g", rows).collect()}
    ties = sum(t**3 - t for t in collections.Counter(v for _, v in known).values())
    for g in {g for g, _ in known}:
        mine = [v for h, v in known if h == g]
        assert (sums[g].n, sums[g].twice_rank_sum, sums[g].ties) == (len(mine), sum(2 * rank[v] for v in mine), ties)


def test_statistics_by_definition(spark):
    got = entry.queries()["m_ab_statistics"](spark, SF).collect()
    assert len(got) == 1
    r = got[0]
    events = spark.read.parquet(f"{SF}/events.parquet").filter("event_type = 'purchase' AND value IS NOT NULL").collect()
    a, b = ([round(e.value, 2) for e in events if (e.user_id % 2 == 0) == side] for side in (True, False))
    assert (r.n_a, r.n_b) == (len(a), len(b))
    close = lambda x, y: math.isclose(x, y, rel_tol=1e-9)
    va, vb = statistics.variance(a) / len(a), statistics.variance(b) / len(b)
    assert close(r.mean_a, statistics.mean(a)) and close(r.var_b, statistics.variance(b))
    assert close(r.welch_t, (statistics.mean(a) - statistics.mean(b)) / math.sqrt(va + vb))
    assert close(r.welch_df, (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1)))
    # U by comparing all pairs, and its variance from the ranks' own sum of squares.
    u = sum((x > y) + (x == y) / 2 for x in a for y in b)
    rank = average_ranks(a + b)
    n = len(a) + len(b)
    spread = len(a) * len(b) / (n * (n - 1)) * (sum(rank[v] ** 2 for v in a + b) - n * (n + 1) ** 2 / 4)
    assert close(r.rank_sum_a, u + len(a) * (len(a) + 1) / 2)
    assert math.isclose(r.rank_sum_z, (u - len(a) * len(b) / 2) / math.sqrt(spread), rel_tol=1e-9, abs_tol=1e-12)


def test_ranks_run_no_window_over_all_values(spark):
    df = spark.createDataFrame(some_values(1, 50, 9), "g string, v decimal(18,2)")
    plan = ranks.value_ranks(df, "v", "g")._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(__of" not in line]
    assert over_rows and all("windowspecdefinition(__range" in line for line in over_rows)


# ------------------------------------------------------------------ prefix sums
@pytest.mark.parametrize("seed", range(3))
def test_running_total_of_long_histories(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.randrange(1500), rng.choice([None, rng.randint(-9, 9)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k int, d int, amount int")
    got = {(r.k, r.d): r.total for r in running_total(df, "k", "d", "amount", "total", rows=64).collect()}
    want, total = {}, {}
    for k, d, amount in sorted(rows, key=lambda r: r[1]):
        if amount is not None:
            total[k] = total.get(k, 0) + amount
        want[k, d] = total.get(k)
    assert got == want


def test_running_total_of_dates_in_blocks(spark):
    rng = random.Random(9)
    first = dt.date(1890, 1, 1)
    rows = [(rng.choice("ab"), rng.choice([None, first + dt.timedelta(days=rng.randrange(50_000))]), rng.randint(-9, 9)) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, d date, amount int")
    got = running_total(df, "k", "d", "amount", "total")
    want, total = {}, collections.Counter()
    for k, d, amount in sorted(rows, key=lambda r: (r[1] is not None, r[1] or first)):
        total[k] += amount
        want[k, d] = total[k]
    assert {(r.k, r.d): r.total for r in got.collect()} == want
    # The days are added up once for both levels.
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_no_window_over_a_whole_key(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.col("id").alias("x"))
    plan = prefix_sums(df, ["k"], "id", {"x": "s"})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    for line in windows:
        # By key and range, or over one row per key and range.
        assert re.search(r"windowspecdefinition\(k#\d+L?, __range", line) or re.search(r"windowspecdefinition\(__k#\d+L?, __of", line)
    assert prefix_sums(df.limit(0), ["k"], "id", {"x": "s"}).count() == 0


# ------------------------------------------------------------------ distinct counts
def test_distinct_counts_merge_over_any_keys(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["x", "y", None]), rng.randrange(5), rng.choice([None, rng.randrange(200_000)])) for _ in range(5000)]
    rows += [("hot", 1, 7)] * 3000
    ids = id_bitmaps(spark.createDataFrame(rows, "t string, d int, u long"), [F.col("t"), F.col("d")], F.col("u"))
    for keys in (["t", "d"], ["t"], ["d"], []):
        of = collections.defaultdict(set)
        for t, d, u in rows:
            if u is not None:
                of[tuple({"t": t, "d": d}[k] for k in keys)].add(u)
        got = {tuple(r[k] for k in keys): r.n for r in merged_counts(ids, keys, "n").collect()}
        assert got == {k: len(v) for k, v in of.items()}


def test_group_comparison_copies_no_rows(spark):
    df = entry.queries()["m_ab_test"](spark, SF)
    assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_subtotals_tell_a_total_from_a_null(spark):
    from fathom.plans import metrics

    rows = [(dt.datetime(2024, 1, d), u, t, v) for d, u, t, v in [
        (1, 1, "a", 1.0), (1, 2, None, 2.0), (1, 1, None, None), (2, None, "a", 4.0), (2, 1, "b", 5.5),
    ]]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, user_id long, event_type string, value double")
    view = type("V", (), {"table": lambda self, name: events})()
    got = {(r.level, r.day and r.day.day, r.event_type): (r.events, r.users, r.total_value) for r in metrics.m_subtotals(view).collect()}
    assert got == {
        (0, 1, "a"): (1, 1, Decimal("1.00")), (0, 1, None): (2, 2, Decimal("2.00")), (0, 2, "a"): (1, 0, Decimal("4.00")),
        (0, 2, "b"): (1, 1, Decimal("5.50")), (1, 1, None): (3, 2, Decimal("3.00")), (1, 2, None): (2, 1, Decimal("9.50")),
        (2, None, "a"): (2, 1, Decimal("5.00")), (2, None, None): (2, 2, Decimal("2.00")), (2, None, "b"): (1, 1, Decimal("5.50")),
        (3, None, None): (5, 2, Decimal("12.50")),
    }
    none = type("V", (), {"table": lambda self, name: events.limit(0)})()
    assert [tuple(r) for r in metrics.m_subtotals(none).collect()] == [(3, None, None, 0, 0, None)]


# ------------------------------------------------------------------ pairs
@pytest.mark.parametrize("block", [1, 7, 4096])
def test_pairs_within_groups(spark, block):
    rng = random.Random(block)
    rows = {(rng.choice([1, 1, 1, 1, 2, None]), "x", rng.choice([None, rng.randrange(300)])) for _ in range(400)}
    df = spark.createDataFrame(sorted(rows, key=str), "g int, h string, i int")
    got = [tuple(r) for r in pairs.pairs_within(df, ["g", "h"], "i", "more", "less", block).collect()]
    want = {(g, "x", a, b) for g, _, a in rows for g2, _, b in rows if g is not None and g == g2 and None not in (a, b) and a > b}
    assert len(got) == len(set(got)) and set(got) == want


def test_pairs_come_in_runs_from_many_tasks(spark):
    """Few rows that make many pairs aren't joined in one task, and one side's items come in runs (files stay small)."""
    df = spark.createDataFrame([("x", i * 7919 % 300) for i in range(300)], "g string, i int")
    met = pairs.pairs_within(df, ["g"], "i", "more", "less", 32)
    rows = met.withColumn("task", F.spark_partition_id()).collect()
    runs = [sum(a[c] != b[c] for a, b in zip(rows, rows[1:])) for c in ("more", "less")]
    # Each of 300 items meets up to 10 blocks.
    assert len(rows) == 300 * 299 // 2 and min(runs) <= 300 * 10
    assert len({r.task for r in rows}) > 1


def shuffled_rows(node):
    """Rows written by each shuffle that the last stage of a plan reads."""
    if node.nodeName() == "ShuffleQueryStage":
        return [node.shuffle().metrics().apply("shuffleRecordsWritten").value()]
    if node.nodeName() in ("AdaptiveSparkPlan", "ResultQueryStage"):
        return shuffled_rows(node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan())
    return [n for i in range(node.children().size()) for n in shuffled_rows(node.children().apply(i))]


def test_pairs_shuffle_a_row_per_block_and_drop_no_pair(spark):
    """Blocks meet as arrays: 300 items in 10 blocks are 55 rows on both sides, not some 1650, and no pair is compared."""
    df = spark.createDataFrame([("x", f"{i * 7919 % 300:03d}") for i in range(300)], "g string, i string")
    met = pairs.pairs_within(df, ["g"], "i", "more", "less", 32)
    got = [(r.more, r.less) for r in met.collect()]
    plan = met._jdf.queryExecution().executedPlan()
    assert sorted(got) == sorted((f"{a:03d}", f"{b:03d}") for a in range(300) for b in range(a))
    assert shuffled_rows(plan) == [55, 55]
    top = plan.executedPlan().toString().split("Generate posexplode")[0]
    assert "SortMergeJoin" in top and "Filter" not in top


# ------------------------------------------------------------------ dashboard tables
def day(n):
    return dt.date(2024, 1, n)


def some_events(rng, days, n=60):
    return [
        (dt.datetime(2024, 1, rng.choice(days), rng.randrange(24), 59, 59), rng.randrange(9), rng.choice(["view", "buy", None]),
         rng.choice([None, rng.randrange(500) / 100])) for _ in range(n)
    ]


def plain_report(events, by, first=1, last=31):
    groups = collections.defaultdict(list)
    for ts, user, kind, value in events:
        if first <= ts.day <= last:
            groups[tuple({"day": ts.date(), "event_type": kind}[k] for k in by)].append((user, value))
    out = {}
    for key, rows in groups.items():
        values = [Decimal(f"{v:.2f}") for _, v in rows if v is not None]
        total = sum(values) if values else None
        out[key] = (len(rows), len({u for u, _ in rows if u is not None}), total, float(total) / len(values) if values else None)
    return out


def files(folder):
    found = {}
    for root, _, names in os.walk(folder):
        found |= {os.path.join(root, n): os.stat(os.path.join(root, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def test_a_refresh_replaces_its_days_only(spark, tmp_path):
    rng = random.Random(6)
    folder = str(tmp_path / "board")
    events = some_events(rng, [1, 2, 3])

    def frame():
        return spark.createDataFrame(events, "ts timestamp_ntz, user_id long, event_type string, value double")

    def check():
        for by in (["day", "event_type"], ["day"], ["event_type"], []):
            got = {tuple(r[k] for k in by): tuple(r)[len(by):] for r in dashboard.report(spark, folder, by).collect()}
            assert got == plain_report(events, by)
        got = {r.event_type: r.users for r in dashboard.report(spark, folder, ["event_type"], day(2), day(3)).collect()}
        assert got == {k[0]: v[1] for k, v in plain_report(events, ["event_type"], 2, 3).items()}

    dashboard.refresh(spark, frame(), folder, [day(1), day(2), day(3)])
    check()
    before = files(folder)
    # A day is appended: nothing else is written.
    events += some_events(rng, [4])
    dashboard.refresh(spark, frame(), folder, [day(4)])
    after = files(folder)
    assert all(after.get(f) == t for f, t in before.items()) and any("day=2024-01-04" in f for f in after)
    check()
    # A rerun, after a correction of one day and the loss of another's events.
    events = [e for e in events if e[0].day != 3] + some_events(rng, [2], 5)
    dashboard.refresh(spark, frame(), folder, [day(2), day(3)])
    dashboard.refresh(spark, frame(), folder, [day(2), day(3)])
    check()
    untouched = {f: t for f, t in files(folder).items() if "day=2024-01-01" in f or "day=2024-01-04" in f}
    assert untouched and all(after.get(f) == t for f, t in untouched.items())
    dashboard.refresh(spark, frame(), folder, [])
    check()
