"""Every registered query equals its SQL oracle (DuckDB) on generated data."""

import os

import pytest

import __spark_entry__ as entry
from fathom.plans import registry
from tools.check_oracle import compare, duck_connect

SF = os.environ.get("FATHOM_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(registry.load_all())
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    problems, ns, nd, _ = compare(spark, duck, SF, key, entry.queries()[key], ORACLE[key])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["point", "day", "balance"]
    assert df.count() > 0


@pytest.mark.parametrize(
    "key", ["e39_later_battle", "e43_not_in", "e60_balance_before", "e66_calendar", "e69_running_balance", "e75_asof_forward", "m_alerts", "m_daily_report"]
)
def test_dates_do_not_depend_on_session_time_zone(spark, duck, key):
    """Date and hour logic works on time-zone-free timestamps: the answers
    are the same in a session zone with an offset and daylight saving."""
    saved = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        problems, _, _, _ = compare(spark, duck, SF, key, entry.queries()[key], ORACLE[key])
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
    assert not problems, problems
