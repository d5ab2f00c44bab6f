"""Aggregation patterns: top-with-ties, NULL-poisoned max, group tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_poisoned_max(value: Column) -> Column:
    """``max(value)``, but NULL as soon as one input of the group is NULL."""
    return F.when(F.count_if(value.isNull()) == 0, F.max(value))


def top_with_ties(
    df: DataFrame,
    value: str,
    by: list[str] | tuple[str, ...] = (),
    largest: bool = True,
    few_groups: bool = False,
) -> DataFrame:
    """Rows holding the extreme ``value`` (per ``by`` group), ties kept.

    Global form: one scalar subquery (the extreme is a single value that
    every task receives as a constant).  Grouped form: aggregate, then join
    the per-group extreme back on (group, value).  The aggregate output has
    one row per group, so when groups are few -- the skewed case, e.g. six
    displacement values over millions of ships -- AQE broadcasts it and the
    large side is never shuffled; a window partitioned by the group would
    instead push each whole group through one task.  NULL groups and NULL
    values never match, as with the SQL join-back.  ``few_groups`` asserts
    that the number of groups is bounded independently of the data (e.g.
    groups taken from a fixed dimension) and broadcasts the maxima
    explicitly instead of relying on the runtime size.
    """
    pick = F.max if largest else F.min
    if not by:
        return df.filter(F.col(value) == df.agg(pick(value)).scalar())
    best = df.groupBy(*[F.col(c).alias(f"__by_{c}") for c in by]).agg(pick(value).alias("__best"))
    if few_groups:
        best = F.broadcast(best)
    cond = [F.col(c) == F.col(f"__by_{c}") for c in by] + [F.col(value) == F.col("__best")]
    return df.join(best, cond, "inner").select(*df.columns)


def divides(candidates: DataFrame, group: str, member: str, present: DataFrame, present_member: str) -> DataFrame:
    """Relational division: groups all of whose members occur in ``present``.

    ``present`` is reduced to its distinct members before the left join, so
    each candidate row matches at most once; a group qualifies when every
    one of its rows found a match.
    """
    seen = present.select(F.col(present_member).alias("__seen")).distinct()
    joined = candidates.join(seen, candidates[member] == seen["__seen"], "left")
    return (
        joined.groupBy(group)
        .agg(F.count(F.lit(1)).alias("__n"), F.count("__seen").alias("__hit"))
        .filter(F.col("__n") == F.col("__hit"))
        .select(group)
    )
