"""Entity unions across two tables (a ship known from either table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def every_ship(ships: DataFrame, outcomes: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Distinct (name, class): ships as listed, plus ships from battle outcomes
    that are taken as their own class (``ship AS name, ship AS class``).
    ``outcomes`` only needs a ``ship`` column; the set of outcome ships
    (``Views.outcome_ships``) is enough.

    When ``classes`` is given (a bounded dimension: it is broadcast), only
    ships whose class exists there are kept
    -- applied to each branch *before* the union, so the distinct runs on
    the (few) outcome ships that name a class instead of on every outcome.
    """
    listed = ships.select("name", "class")
    from_outcomes = outcomes.select(F.col("ship").alias("name"), F.col("ship").alias("class"))
    if classes is not None:
        known = F.broadcast(classes.select(F.col("class").alias("__c")).distinct())
        listed = listed.join(known, listed["class"] == known["__c"], "left_semi")
        from_outcomes = from_outcomes.join(known, from_outcomes["class"] == known["__c"], "left_semi")
    return listed.union(from_outcomes).distinct()
