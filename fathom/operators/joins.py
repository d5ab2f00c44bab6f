"""Joins Spark does not plan well when written literally.

``either_key_join`` replaces ``ON r.k = l.a OR r.k = l.b``: written as an OR
condition Spark can only run it as a nested-loop join (every left row against
every right row).  Here it becomes equi-joins only: each left row is expanded
to its distinct candidate keys and hash/sort-merge joined on that key.

``not_in`` is the null-aware ``x NOT IN (subquery)`` as an ordinary anti join
plus two scalar flags, instead of the null-aware nested-loop plan Spark falls
back to when the subquery side is too large to broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEY, _PART, _TURN, _HIT, _ANY = (f"__either_{n}" for n in ("key", "part", "turn", "hit", "any"))


def either_key_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: list[str],
    right_key: str,
    how: str = "inner",
    broadcast_right: bool = False,
) -> DataFrame:
    """``left JOIN right ON right.k = left.a OR right.k = left.b [OR ...]``.

    ``how`` is ``"inner"`` or ``"left"``.  Column names of the two inputs
    must be disjoint.  Bag semantics are kept: a left row matching two
    different right rows yields two rows; a left row whose keys are equal
    matches that right row once; duplicated left rows stay duplicated; NULL
    keys never match.  For ``"left"``, a row without any match is emitted
    once with NULL right-hand columns.

    ``broadcast_right`` is for a right side whose size is bounded
    independently of the data volume (a dimension such as one row per
    nation): it keeps the left side from being shuffled onto a handful of
    key values.  Otherwise there is one join, whose strategy is left to
    Spark/AQE, and for ``"left"`` one exchange more, by the left row; its
    columns must then be of types that can be compared (no maps).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"either_key_join needs disjoint columns, shared: {sorted(overlap)}")
    if how == "inner":
        if broadcast_right:
            right = F.broadcast(right)
        expanded = left.withColumn(_KEY, F.explode(F.array_distinct(F.array(*[F.col(k) for k in left_keys]))))
        return expanded.join(right, F.col(_KEY) == right[right_key], "inner").drop(_KEY)
    own = _own_keys(left_keys)
    if broadcast_right:
        return _looked_up(left, right, own, right_key)
    # Each row asks once for each of its keys.  Its answers meet again by the
    # row itself: equal rows have equal answers, so they may meet together,
    # and the number of the partition deals them out.  (That number, unlike a
    # row id, is the same when a lost task runs again.)
    asked = F.filter(F.array(*own), lambda k: k.isNotNull())
    asking = left.withColumn(_PART, F.spark_partition_id()).select("*", F.posexplode_outer(asked).alias(_TURN, _KEY))
    answered = asking.join(right.withColumn(_HIT, F.lit(True)), F.col(_KEY) == right[right_key], "left")
    same_row = Window.partitionBy(_PART, *left.columns)
    answered = answered.withColumn(_ANY, F.max(_HIT).over(same_row))
    first_of_none = F.col(_ANY).isNull() & (F.coalesce(F.col(_TURN), F.lit(0)) == 0)
    return answered.filter(F.col(_HIT) | first_of_none).drop(_PART, _TURN, _KEY, _HIT, _ANY)


def _own_keys(names: list[str]) -> list[Column]:
    """The keys of a row, NULL in place of one that an earlier column has."""
    own = []
    for i, name in enumerate(names):
        repeated = [F.col(name).eqNullSafe(F.col(earlier)) for earlier in names[:i]]
        own.append(F.when(~reduce(Column.__or__, repeated), F.col(name)) if repeated else F.col(name))
    return own


def _looked_up(left: DataFrame, right: DataFrame, own: list[Column], right_key: str) -> DataFrame:
    """The left join to a bounded right side, as a lookup: no join and no shuffle of the left side.

    The right rows by key are one value, computed once and shipped to every task.
    """
    by_key = right.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias(_KEY)).agg(
        F.collect_list(F.struct(*right.columns)).alias(_HIT)
    )
    table = by_key.agg(F.map_from_entries(F.collect_list(F.struct(_KEY, _HIT)))).scalar()
    found = F.flatten(F.array_compact(F.array(*[F.try_element_at(table, k) for k in own])))
    return left.select("*", F.explode_outer(found).alias(_HIT)).select(*left.columns, f"{_HIT}.*")


def not_in(df: DataFrame, value: Column, sub: DataFrame, sub_col: str) -> DataFrame:
    """Rows of ``df`` where ``value NOT IN (SELECT sub_col FROM sub)`` is TRUE.

    SQL three-valued logic: with an empty subquery every row qualifies (even a
    NULL value); a NULL in the subquery makes the predicate never TRUE; a
    NULL value qualifies only for an empty subquery.
    """
    # Distinct first: the anti join only needs each value once, and the
    # map-side partial distinct shrinks e.g. every ship's launch year to the
    # few distinct years before anything is shuffled.
    keys = sub.select(F.col(sub_col).alias("__nin")).distinct()
    # Both flags from one aggregate, evaluated once as a scalar subquery.
    flags = keys.agg(
        F.struct(
            (F.count(F.lit(1)) > 0).alias("nonempty"),
            (F.count_if(F.col("__nin").isNull()) > 0).alias("has_null"),
        )
    ).scalar()
    kept = df.join(keys.filter(F.col("__nin").isNotNull()), value == F.col("__nin"), "left_anti")
    return kept.filter(~flags["nonempty"] | (value.isNotNull() & ~flags["has_null"]))
