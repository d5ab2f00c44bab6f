"""Forward as-of lookup: for each probe value, the first event at or after it.

Spark has no as-of join.  Both sides are reduced to their distinct keys, which
are divided into ranges of the key; an ordered window runs within each range,
and a probe behind the last event of its range takes the first event of the
ranges that follow.  The result is a key -> event map that the caller
equi-joins to the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators.ranges import cuts, with_rank


def first_event_from(
    probes: DataFrame, probe_key: str, events: DataFrame, event_key: str, event_value: str, order: str, rows: int | None = None
) -> DataFrame:
    """Map each distinct ``probe_key`` to the earliest event with key >= it.

    ``events`` rows are (event_key, event_value, order); among the events of
    the first qualifying key the one with the smallest ``order`` wins.  Probe
    keys with no event at or after them map to NULL; NULL keys are left out.
    Returns (probe_key, event_value).

    Keys may be years as well as days or ids: ranges hold about ``rows``
    distinct keys (by default some 260,000), so more keys make more ranges, and
    only one event a range is looked at outside of it.
    """
    first_per_key = (
        events.where(F.col(event_key).isNotNull())
        .groupBy(F.col(event_key).alias("__k"))
        .agg(F.min_by(F.struct(F.col(event_value).alias("v")), order).alias("__v"))
    )
    keys = probes.select(F.col(probe_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    between = cuts(keys.unionByName(first_per_key.select("__k")), F.col("__k"), rows)
    nothing = F.lit(None).cast(first_per_key.schema["__v"].dataType)
    events_in = with_rank(first_per_key, between, F.col("__k"), "__range")
    probes_in = with_rank(keys, between, F.col("__k"), "__range")
    tagged = events_in.withColumn("__probe", F.lit(0)).unionByName(
        probes_in.select("__k", nothing.alias("__v"), "__range", F.lit(1).alias("__probe"))
    )
    # At equal keys the probe row sorts first, so "following rows" include
    # the events of the same key (key >= probe, inclusive).
    w = (
        Window.partitionBy("__range")
        .orderBy(F.col("__k"), F.col("__probe").desc())
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    resolved = tagged.select("__range", "__k", "__probe", F.first("__v", ignorenulls=True).over(w).alias("__v"))
    resolved = resolved.where(F.col("__probe") == 1)
    # The first event of each range that has one, in order of the ranges: a probe takes that of the ranges behind its own.
    heads = events_in.groupBy(F.col("__range").alias("r")).agg(F.min_by("__v", "__k").alias("v"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("r", "v"))).alias("h"))
    carried = resolved.withColumn("__h", heads.select(F.struct(F.col("h.r").alias("r"), F.col("h.v").alias("v"))).scalar())
    ahead = with_rank(carried, F.col("__h.r"), F.col("__range"), "__n")
    found = F.coalesce("__v", F.get("__h.v", F.col("__n")))["v"]
    return ahead.select(F.col("__k").alias(probe_key), found.alias(event_value))
