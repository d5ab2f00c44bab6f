"""Operators against brute-force SQL (DuckDB) on random rows with NULLs and
duplicates, plus plan-shape checks."""

import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fathom.operators.asof import first_event_from
from fathom.operators.joins import either_key_join, not_in
from fathom.operators.subquery import filter_all
from fathom.operators.windows import global_row_number, running_total
from tools.check_oracle import compare_frames


DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


def _frame(spark, con, name, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    cols = [c.split() for c in ddl.split(",")]
    pdf = pd.DataFrame(rows, columns=[c for c, _ in cols], dtype=object)
    con.register(f"{name}_pd", pdf)
    select = ", ".join(f"CAST({c} AS {DUCK_TYPES[t]}) AS {c}" for c, t in cols)
    con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT {select} FROM {name}_pd")
    return df


def _maybe(rng, domain, p_null=0.2):
    return None if rng.random() < p_null else rng.choice(domain)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bounded", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_either_key_join_matches_or_join(spark, seed, how, bounded):
    rng = random.Random(seed)
    con = duckdb.connect()
    keys = ["k1", "k2", "k3", "k4"]
    left_rows = [(i % 9, _maybe(rng, keys), _maybe(rng, keys)) for i in range(40)]
    left_rows += left_rows[:5]  # duplicated left rows stay duplicated
    right_rows = [(k, n) for n, k in enumerate(keys[:3])] + [("k1", 99)]  # duplicate right key
    left = _frame(spark, con, "l", left_rows, "id int, a string, b string")
    right = _frame(spark, con, "r", right_rows, "k string, v int")
    got = either_key_join(left, right, ["a", "b"], "k", how, bounded).select("id", "a", "b", "k", "v")
    join = "JOIN" if how == "inner" else "LEFT JOIN"
    want = con.sql(f"SELECT l.id, l.a, l.b, r.k, r.v FROM l {join} r ON r.k = l.a OR r.k = l.b")
    problems, _, _ = compare_frames(got, want)
    assert not problems, problems
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize(
    "sub_rows", [[(5,), (7,), (9,)], [], [(5,), (None,)], [(None,)], [(1,), (20,)]], ids=["plain", "empty", "null", "only_null", "low"]
)
@pytest.mark.parametrize("op", ["<", "<=", ">", ">="])
def test_filter_all_matches_sql_all(spark, sub_rows, op):
    con = duckdb.connect()
    vals = [(x,) for x in [None, 1, 4, 5, 6, 9, 10, 30]]
    df = _frame(spark, con, "t", vals, "x int")
    sub = spark.createDataFrame(sub_rows, "y int")
    con.register("s_pd", pd.DataFrame(sub_rows, columns=["y"], dtype="Int32"))
    con.execute("CREATE OR REPLACE TABLE s AS SELECT CAST(y AS INTEGER) AS y FROM s_pd")
    got = filter_all(df, F.col("x"), op, sub, "y")
    want = con.sql(f"SELECT x FROM t WHERE x {op} ALL (SELECT y FROM s)")
    problems, _, _ = compare_frames(got, want)
    assert not problems, problems


@pytest.mark.parametrize(
    "sub_rows", [[(1,), (2,)], [], [(1,), (None,)], [(None,)]], ids=["plain", "empty", "with_null", "only_null"]
)
def test_not_in_is_null_aware(spark, sub_rows):
    con = duckdb.connect()
    df = _frame(spark, con, "t", [(None,), (1,), (2,), (3,), (3,)], "x int")
    sub = spark.createDataFrame(sub_rows, "y int")
    con.register("s_pd", pd.DataFrame(sub_rows, columns=["y"], dtype="Int32"))
    con.execute("CREATE OR REPLACE TABLE s AS SELECT CAST(y AS INTEGER) AS y FROM s_pd")
    got = not_in(df, F.col("x"), sub, "y").select("x")
    want = con.sql("SELECT x FROM t WHERE x NOT IN (SELECT y FROM s)")
    problems, _, _ = compare_frames(got, want)
    assert not problems, problems


def test_global_row_number_equals_single_partition_window(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abcdefghij"), i, rng.random()) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, w double").repartition(5)
    got = global_row_number(df, [F.col("g"), F.col("i")], "rn", buckets=7)
    got_rows = sorted((r.g, r.i, r.rn) for r in got.collect())
    want = sorted(rows, key=lambda r: (r[0], r[1]))
    assert [(g, i, n + 1) for n, (g, i, _) in enumerate(want)] == sorted(got_rows, key=lambda r: r[2])


def test_running_total_shares_total_between_peers(spark):
    con = duckdb.connect()
    rng = random.Random(3)
    rows = [(rng.randint(1, 3), rng.randint(1, 6), _maybe(rng, list(range(-5, 10)), 0.15)) for _ in range(80)]
    df = _frame(spark, con, "t", rows, "k int, d int, amt int")
    got = running_total(df, "k", "d", "amt", "total")
    want = con.sql(
        "SELECT DISTINCT k, d, CAST(sum(amt) OVER (PARTITION BY k ORDER BY d RANGE UNBOUNDED PRECEDING) AS BIGINT) AS total FROM t"
    )
    problems, _, _ = compare_frames(got, want)
    assert not problems, problems


def test_first_event_from_matches_brute_force(spark):
    rng = random.Random(11)
    events = [(y, f"e{y}_{m}", y * 100 + m) for y in sorted(rng.sample(range(1990, 2010), 8)) for m in rng.sample(range(1, 12), 2)]
    probes = [(p,) for p in [None, 1985, 1995, 1999, 2003, 2009, 2011, 1995]]
    ev = spark.createDataFrame(events, "y int, name string, ord int")
    pr = spark.createDataFrame(probes, "p int")
    got = {r.p: r.name for r in first_event_from(pr, "p", ev, "y", "name", "ord").collect()}
    for (p,) in probes:
        if p is None:
            continue
        later = [e for e in events if e[0] >= p]
        expect = min(later, key=lambda e: e[2])[1] if later else None
        assert got[p] == expect, (p, got[p], expect)
    assert None not in got


def test_hot_key_results_are_whole(spark):
    """One key holding a third of the rows: results stay complete and exact."""
    from fathom.operators.aggregates import top_with_ties

    con = duckdb.connect()
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}", i % 7) for i in range(3000)]
    df = _frame(spark, con, "t", rows, "id int, g string, v int")
    got = top_with_ties(df, "v", by=["g"])
    want = con.sql("SELECT t.* FROM t JOIN (SELECT g, max(v) AS m FROM t GROUP BY g) x ON t.g = x.g AND t.v = x.m")
    problems, n, _ = compare_frames(got, want)
    assert not problems, problems
    assert n > 0
    right = _frame(spark, con, "r", [("hot", 1), ("k1", 2)], "k string, w int")
    left = df.select("id", F.col("g").alias("a"), F.lit("k1").alias("b"))
    con.execute("CREATE OR REPLACE TABLE l AS SELECT id, g AS a, 'k1' AS b FROM t")
    got = either_key_join(left, right, ["a", "b"], "k", "left").select("id", "a", "b", "k", "w")
    want = con.sql("SELECT l.id, l.a, l.b, r.k, r.w FROM l LEFT JOIN r ON r.k = l.a OR r.k = l.b")
    problems, _, _ = compare_frames(got, want)
    assert not problems, problems


def test_left_either_key_join_of_equal_rows_and_null_right_keys(spark):
    """A third of all rows are equal and match nothing: each stays once; NULL on the right matches no NULL."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("none")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("k7")).cast("string").alias("b"),
    ).repartition(6)
    right = spark.createDataFrame([("k7", 1), ("k8", 2), ("k8", 3), (None, 4)], "k string, v int")
    both = [either_key_join(left, right, ["a", "b"], "k", "left", bounded) for bounded in (False, True)]
    counts = [{tuple(r[:4]): r.n for r in d.groupBy("a", "b", "k", "v").agg(F.count(F.lit(1)).alias("n")).collect()} for d in both]
    assert counts[0] == counts[1]
    assert counts[0][("none", None, None, None)] == 1000
    assert sum(n for (a, _, k, _), n in counts[0].items() if k == "k7") == 2000
    assert counts[0][("k8", "k7", "k8", 2)] == counts[0][("k8", "k7", "k8", 3)] == counts[0][("k8", "k7", "k7", 1)]


def test_left_either_key_join_has_one_join(spark):
    left = spark.createDataFrame([(1, "a", "b", "c")], "id int, x string, y string, z string")
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    for bounded, joins in ((False, 1), (True, 0)):
        got = either_key_join(left, right, ["x", "y", "z"], "k", "left", bounded)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        rows = [line for line in plan.split("\n") if not line.lstrip(" :+-").startswith("Subquery")]
        assert sum("Join " in line for line in rows) == joins
        if bounded:
            main = got._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
            assert "Exchange" not in main


def test_global_row_number_spreads_a_hot_ordering_value(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 97:02d}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, i int")
    got = global_row_number(df, [F.col("g")], "rn", buckets=8)
    numbers = sorted(r.rn for r in got.collect())
    assert numbers == list(range(1, 6001))
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r.g, []).append(r.rn)
    order = sorted(by_key)
    # every key occupies one contiguous block of numbers, blocks in key order
    start = 1
    for k in order:
        block = sorted(by_key[k])
        assert block == list(range(start, start + len(block)))
        start += len(block)
    sizes = got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) > 1


@pytest.mark.parametrize("seed", [5, 6])
def test_ledger_operators_match_full_join_sql(spark, seed):
    from fathom.operators.ledger import merge_ledgers, one_sided_days

    rng = random.Random(seed)
    con = duckdb.connect()
    inc_rows = [(rng.randint(1, 3), rng.randint(1, 8), _maybe(rng, list(range(1, 50)), 0.2)) for _ in range(40)]
    out_rows = [(rng.randint(1, 3), rng.randint(1, 8), _maybe(rng, list(range(1, 50)), 0.2)) for _ in range(40)]
    inc = _frame(spark, con, "i", inc_rows, "point int, d int, inc int")
    out = _frame(spark, con, "o", out_rows, "point int, d int, out int")
    got = merge_ledgers(inc, out, ["point", "d"], "inc", "out")
    want = con.sql(
        "SELECT point, d, CAST(sum(inc) AS BIGINT) AS inc, CAST(sum(out) AS BIGINT) AS out FROM "
        "(SELECT point, d, inc, NULL AS out FROM i UNION ALL SELECT point, d, NULL, out FROM o) GROUP BY point, d"
    )
    problems, _, _ = compare_frames(got, want)
    assert not problems, problems
    sides = {"inc": {}, "out": {}}
    for label, rows in (("inc", inc_rows), ("out", out_rows)):
        for point, day, amount in rows:
            sides[label].setdefault((point, day), []).append(amount)
    expected = set()
    for key in sides["inc"].keys() | sides["out"].keys():
        sums = {}
        for label, days in sides.items():
            known = [x for x in days.get(key, []) if x is not None]
            sums[label] = sum(known) if known else None
        if None in sums.values():
            operation = "inc" if key in sides["inc"] else "out"
            expected.add((*key, operation, sums["inc"] if sums["inc"] is not None else sums["out"]))
    got = one_sided_days(inc, out, ["point", "d"], "inc", "out").collect()
    assert len(got) == len(expected)
    assert {(r.point, r.d, r.side, r.amount) for r in got} == expected


def _shares(rows):
    """Percent of each category in each group's members, counted one row at a time."""
    groups, kinds, held = {r[0] for r in rows}, {r[2] for r in rows}, {}
    for group, member, kind in rows:
        if kind is not None and member is not None:
            held[group, kind] = held.get((group, kind), 0) + 1
    out = {}
    for group in groups:
        whole = sum(n for (g, _), n in held.items() if g == group)
        for kind in kinds:
            part = Decimal(100 * held.get((group, kind), 0))
            out[group, kind] = (part / whole).quantize(Decimal("0.01"), ROUND_HALF_UP) if whole else None
    return out


@pytest.mark.parametrize("seed", [8, 9])
def test_share_of_group_counts_every_cell(spark, seed):
    from fathom.operators.shares import share_of_group

    rng = random.Random(seed)
    rows = [(f"m{rng.randint(1, 6)}", f"x{i}", _maybe(rng, ["A", "B", "C"], 0.15)) for i in range(60)]
    df = spark.createDataFrame(rows, "maker string, model string, type string")
    got = share_of_group(df, "maker", "type", "model", "pct").collect()
    assert {(r.maker, r.type): r.pct for r in got} == _shares(rows)
    assert len(got) == len(_shares(rows))


def test_share_of_group_takes_any_number_of_categories(spark):
    from fathom.operators.shares import share_of_group

    rows = [(f"m{i % 3}", f"x{i}", f"t{i % 1500}") for i in range(4000)]
    df = spark.createDataFrame(rows, "maker string, model string, type string")
    got = share_of_group(df, "maker", "type", "model", "pct").collect()
    assert {(r.maker, r.type): r.pct for r in got} == _shares(rows)


def test_appended_files_are_read(spark, tmp_path):
    from fathom.plans import registry

    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").orderBy("p_partkey")
    path = str(tmp_path / "part.parquet")
    part.limit(50).write.parquet(path)
    before = registry.run(spark, str(tmp_path), "e02_distinct").count()
    part.subtract(part.limit(50)).write.mode("append").parquet(path)
    after = registry.run(spark, str(tmp_path), "e02_distinct").count()
    assert after > before


def test_day_of_reads_day_first(spark):
    import datetime as dt

    from fathom.functions.dialect import day_of

    df = spark.createDataFrame([("03/02/2001",), ("31/12/1999",), (None,)], "t string")
    assert [r.d for r in df.select(day_of(F.col("t")).alias("d")).collect()] == [dt.date(2001, 2, 3), dt.date(1999, 12, 31), None]


def test_full_join_using_keeps_both_sides(spark):
    from fathom.operators.ledger import full_join_using

    a = spark.createDataFrame([(1, 10, 5), (2, 10, 6)], "point int, date int, inc int")
    b = spark.createDataFrame([(2, 10, 7), (3, 11, 8)], "point int, date int, out int")
    got = {(r.point, r.date, r.inc, r.out) for r in full_join_using(a, b, ["point", "date"]).collect()}
    assert got == {(1, 10, 5, None), (2, 10, 6, 7), (3, 11, None, 8)}


def test_either_key_join_three_keys_property(spark):
    """Property: for random left rows with three candidate keys (NULLs,
    repeats, equal keys) and a right side with duplicate keys, the rewrite
    equals the OR join, for inner and left joins."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    key = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
    left_rows = st.lists(st.tuples(st.integers(0, 5), key, key, key), min_size=0, max_size=12)
    right_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "e"]), st.integers(0, 3)), min_size=0, max_size=6)

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(left_rows, right_rows, st.sampled_from(["inner", "left"]), st.booleans())
    def check(lrows, rrows, how, bounded):
        con = duckdb.connect()
        left = _frame(spark, con, "l", lrows, "id int, a string, b string, c string")
        right = _frame(spark, con, "r", rrows, "k string, v int")
        got = either_key_join(left, right, ["a", "b", "c"], "k", how, bounded).select("id", "a", "b", "c", "k", "v")
        join = "JOIN" if how == "inner" else "LEFT JOIN"
        want = con.sql(f"SELECT l.id, l.a, l.b, l.c, r.k, r.v FROM l {join} r ON r.k = l.a OR r.k = l.b OR r.k = l.c")
        problems, _, _ = compare_frames(got, want)
        assert not problems, problems

    check()
