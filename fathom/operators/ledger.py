"""Cash-ledger patterns: merging income and outgo, one-sided days.

A "padded union" (``inc, NULL`` UNION ALL ``NULL, out`` then GROUP BY) merges
two ledgers with a single shuffle and map-side partial aggregation; it is the
right tool when each side can have many rows per key.  A FULL JOIN USING is
used where the query needs to see which side was present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def padded_union(inc: DataFrame, out: DataFrame, keys: list[str], inc_col: str, out_col: str) -> DataFrame:
    """(keys, inc_col, out_col) rows: income rows with NULL outgo and vice versa."""
    left = inc.select(*keys, F.col(inc_col), F.lit(None).cast(out.schema[out_col].dataType).alias(out_col))
    right = out.select(*keys, F.lit(None).cast(inc.schema[inc_col].dataType).alias(inc_col), F.col(out_col))
    return left.unionByName(right)


def merge_ledgers(inc: DataFrame, out: DataFrame, keys: list[str], inc_col: str, out_col: str, agg=F.sum) -> DataFrame:
    """One row per key with ``agg`` of each side; NULL where a side is absent."""
    merged = padded_union(inc, out, keys, inc_col, out_col)
    return merged.groupBy(*keys).agg(agg(inc_col).alias(inc_col), agg(out_col).alias(out_col))


def full_join_using(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``FULL JOIN ... USING (keys)``: key columns are coalesced from both sides."""
    return left.join(right, keys, "full")


def one_sided_days(inc: DataFrame, out: DataFrame, keys: list[str], inc_col: str, out_col: str) -> DataFrame:
    """Keys whose daily income sum or daily outgo sum is missing (NULL).

    Equivalent to aggregating both ledgers per key, FULL JOINing them and
    keeping rows where either sum IS NULL -- including the corner case of a
    side that has rows but only NULL amounts (its sum is NULL, yet its
    operation label is still the one reported).  Done as one union and one
    aggregate: a single shuffle instead of two aggregates and a join.  The
    keys are the ledger's primary key (never NULL), where grouping and the
    join's key equality agree.
    Returns (keys, side, amount).
    """
    both = inc.select(*keys, F.col(inc_col).alias("__amt"), F.lit(True).alias("__is_inc")).unionByName(
        out.select(*keys, F.col(out_col).alias("__amt"), F.lit(False).alias("__is_inc"))
    )
    daily = both.groupBy(*keys).agg(
        F.sum(F.when(F.col("__is_inc"), F.col("__amt"))).alias("__inc"),
        F.sum(F.when(~F.col("__is_inc"), F.col("__amt"))).alias("__out"),
        F.max(F.col("__is_inc").cast("int")).alias("__has_inc"),
        F.max((~F.col("__is_inc")).cast("int")).alias("__has_out"),
    )
    return daily.filter(F.col("__inc").isNull() | F.col("__out").isNull()).select(
        *keys,
        F.when(F.col("__has_inc") == 1, F.lit("inc")).when(F.col("__has_out") == 1, F.lit("out")).alias("side"),
        F.coalesce(F.col("__inc"), F.col("__out")).alias("amount"),
    )
