"""The domain tables as Spark SQL temp views: SQL written for the schemas
runs on Spark and agrees with the DataFrame queries."""

import pytest

from fathom.plans.registry import load_all
from fathom.sources.views import Views
from tools.check_oracle import compare_frames, duck_connect

SF = "/root/testdata/sf0.001"
# Oracle texts that are also valid Spark SQL (no engine-specific functions).
PORTABLE = [
    "e01_filter", "e06_join_distinct", "e08_except", "e10_in_max", "e14_join_filter", "e15_having",
    "e16_self_pairs", "e20_count_having", "e23_intersect", "e25_nested_in",
    "e29_ledger_min", "e36_union_in", "e37_union_having", "e39_later_battle", "e40_single_type",
    "e41_null_poison_max", "e46_either_key_left", "e47_all_lost", "e48_class_sunk", "e51_group_max",
    "e52_maybe", "e55_min_launch", "e56_count_sunk", "e57_sunk_of_three", "e59_balance", "e60_balance_before",
    "e61_total_balance", "e63_same_seat", "e64_one_sided_days", "e67_top_routes", "e70_three_of_country",
    "e71_division", "e72_loyal_top", "e74_fallback", "e76_flight_minutes",
]


@pytest.fixture(scope="module")
def registered(spark):
    Views(spark, SF).register()
    return duck_connect(SF)


@pytest.mark.parametrize("key", PORTABLE)
def test_sql_on_registered_views(spark, registered, key):
    from fathom.sources.sql_views import with_views

    sql = load_all()[key].sql
    got = spark.sql(sql)
    problems, _, _ = compare_frames(got, registered.sql(with_views(sql)))
    assert not problems, problems


def test_a_table_is_listed_anew_and_its_schema_found_once(spark, tmp_path):
    from fathom.sources import tables

    root, path = str(tmp_path), str(tmp_path / "events.parquet")
    rows = spark.range(5).selectExpr("id AS event_id", "'view' AS event_type")
    rows.write.parquet(path)
    first = tables.read_table(spark, root, "events")
    assert first.count() == 5 and first.schema == spark.read.parquet(path).schema
    rows.write.mode("append").parquet(path)
    again = tables.read_table(spark, root, "events")
    assert again.count() == 10 and again.schema == first.schema
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    tables.read_table(spark, root, "events")
    assert len(tracker.getJobIdsForGroup()) == before
