"""Bucketed copies: same answers, and the order-key joins need no shuffle."""

import re
import tempfile

import pytest

import __spark_entry__ as entry
from fathom.sources.bucketed import write_bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bucketed_root(spark):
    location = tempfile.mkdtemp(prefix="fathom-bucketed-")
    write_bucketed(spark, SF, "fathom_test_b", buckets=4, location=location)
    return "catalog:fathom_test_b"


@pytest.mark.parametrize("key", ["e66_calendar", "e72_loyal_top", "e76_flight_minutes", "e46_either_key_left", "e69_running_balance"])
def test_same_answers_on_bucketed_tables(spark, bucketed_root, key):
    q = entry.queries()[key]
    a = sorted(map(tuple, q(spark, SF).collect()), key=repr)
    b = sorted(map(tuple, q(spark, bucketed_root).collect()), key=repr)
    assert a == b


def test_order_key_join_reads_buckets_without_exchange(spark, bucketed_root):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = entry.queries()["e76_flight_minutes"](spark, bucketed_root)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if re.search(r"SortMergeJoin \[trip_no#", line))
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    subtree = []
    for line in lines[at + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        subtree.append(line)
    assert any("Bucketed: true" in line for line in subtree)
    assert not any("Exchange" in line for line in subtree), "\n".join(subtree)
