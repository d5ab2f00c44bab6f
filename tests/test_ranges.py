"""Ranges of an order: cuts that grow with the rows, binary search, and operators built on them."""

import random

import pytest
from pyspark.sql import functions as F

from fathom.operators import ranges
from fathom.operators.asof import first_event_from
from fathom.operators.windows import global_row_number


def numbers(spark, n):
    a = F.when(F.col("id") % 10 != 0, F.col("id") * 7919 % 100_003)
    return spark.range(n).select(a.alias("a"), "id").repartition(3)


@pytest.mark.parametrize("values", [[], [5], [1, 3, 3, 3, 8], list(range(0, 300, 3))])
def test_rank_counts_the_values_up_to_it(spark, values):
    probes = spark.createDataFrame([(x,) for x in [None, *range(-2, 303)]], "x int")
    array = F.lit(values).cast("array<int>") if values else F.array().cast("array<int>")
    got = {r.x: r.n for r in ranges.with_rank(probes, array, F.col("x"), "n").collect()}
    assert all(n == sum(v <= x for v in values) for x, n in got.items() if x is not None)


@pytest.mark.parametrize("n, at_least, at_most", [(0, 0, 0), (100, 1, 1), (4000, 2, 8), (40_000, 25, 60)])
def test_ranges_grow_with_the_rows_and_keep_the_order(spark, n, at_least, at_most):
    df = numbers(spark, n)
    key = F.struct("a", "id")
    rows = ranges.with_rank(df, ranges.cuts(df, key, 1000), key, "r").collect()
    rows.sort(key=lambda r: (r.a is not None, r.a or 0, r.id))
    found = [r.r for r in rows]
    assert found == sorted(found) and at_least <= len(set(found)) <= at_most


def test_numbering_in_ranges_chosen_from_the_size(spark, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS", 500)
    df = numbers(spark, 20_000)
    rows = sorted(global_row_number(df, [F.col("a"), F.col("id")]).collect(), key=lambda r: r.rn)
    assert [r.rn for r in rows] == list(range(1, 20_001))
    keys = [(r.a is not None, r.a or 0, r.id) for r in rows]
    assert keys == sorted(keys)


@pytest.mark.parametrize("rows", [None, 40])
def test_first_event_over_many_ranges(spark, rows):
    rng = random.Random(rows)
    days = [(d, f"e{d}", d) for d in sorted(rng.sample(range(5000), 60))] + [(None, "no day", 1)]
    events = [(4200, None, 0)] + [d for d in days if d[0] != 4200]
    probes = [(rng.randrange(-50, 5100),) for _ in range(1500)] + [(None,)]
    got = first_event_from(
        spark.createDataFrame(probes, "p int"), "p", spark.createDataFrame(events, "d int, name string, o int"), "d", "name", "o", rows
    )
    found = {r.p: r.name for r in got.collect()}
    assert set(found) == {p for (p,) in probes if p is not None}
    known = sorted(e[:2] for e in events if e[0] is not None)
    for p, name in found.items():
        assert name == next((n for d, n in known if d >= p), None)


def test_first_event_runs_no_window_over_all_keys(spark):
    events = spark.range(100).select(F.col("id").alias("d"), F.col("id").alias("v"))
    plan = first_event_from(events, "d", events, "d", "v", "v")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("windowspecdefinition(__range" in line for line in windows)
    nothing = events.limit(0)
    assert {r.v for r in first_event_from(events, "d", nothing, "d", "v", "v").collect()} == {None}
    assert first_event_from(nothing, "d", events, "d", "v", "v").count() == 0
