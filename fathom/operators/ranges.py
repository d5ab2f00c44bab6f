"""Ranges of an order that hold about equally many rows, and binary search in sorted arrays.

An ordered window without a partition is one task.  With the rows divided
into ranges of its order, each range is a partition of its own, and what
crosses a range's border is one value a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows a range holds on average, and keys sampled for each cut between ranges.
ROWS, SAMPLED = 1 << 18, 32
#: Steps of the search, each over twice as many values as the one after it.
STEPS = 20


def with_rank(df: DataFrame, values: Column, value: Column, name: str, found: str | None = None) -> DataFrame:
    """``df`` and, as an int, how many of the sorted ``values`` (an array) are at most ``value``; nulls are least.

    ``found`` names a further column: whether ``value`` is one of them.

    A binary search, folded over the sizes of its steps; at most 2^20 - 1
    values are counted.  ``values`` may be a scalar subquery: it becomes a
    column first, as Spark allows none in a fold, and as the fold names it
    once, the optimizer puts it back in place where the other columns of
    ``df`` are plain ones; otherwise rows carry it up to the fold, never
    through a shuffle.
    """
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(STEPS))])
    start = F.struct(F.lit(0).alias("n"), F.when(F.lit(False), value).alias("v"))

    def step(at: Column, p: Column) -> Column:
        up = lambda v: F.when(v <= value, F.struct((at["n"] + p).alias("n"), v.alias("v"))).otherwise(at)
        return F.element_at(F.transform(F.array(F.get("__values", at["n"] + p - 1)), up), 1)

    at = df.withColumn("__values", values).select(*[F.col(c) for c in df.columns], F.aggregate(powers, start, step).alias("__at"))
    ranks = [F.col("__at.n").alias(name)]
    if found is not None:
        ranks.append(((F.col("__at.n") > 0) & F.col("__at.v").eqNullSafe(value)).alias(found))
    return at.select(*[F.col(c) for c in df.columns], *ranks)


def cuts(keys: DataFrame, key: Column, rows: int | None = None) -> Column:
    """The keys between ranges of about ``rows`` rows, a sorted array as a scalar subquery.

    ``keys`` should have few rows of one key.  A fixed share of its distinct
    keys, told by their hash, is sorted, and every ``SAMPLED``-th is a cut: so
    the number of ranges grows with the rows, the same keys give the same cuts
    wherever the subquery is evaluated, and no job runs while a plan is
    built.  The cuts are as many as Spark's own range partitioning would hold
    on the driver: one key per ``rows`` rows.  No rows, no cuts.
    """
    rows = max(SAMPLED, ROWS if rows is None else rows)
    sample = keys.select(key.alias("k")).filter(F.pmod(F.xxhash64("k", F.lit(11)), F.lit(rows)) < SAMPLED).distinct()
    ordered = sample.agg(F.sort_array(F.collect_list("k")).alias("s"))
    return ordered.select(F.filter("s", lambda _, i: (i + 1) % SAMPLED == 0)).scalar()
