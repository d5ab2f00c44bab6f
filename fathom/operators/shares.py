"""Share of each category within a group, over the full group x category grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def share_of_group(df: DataFrame, group: str, category: str, member: str, name: str) -> DataFrame:
    """Percent of ``member`` count per (group, category) over the group total.

    Every group gets a row for every category of the domain (0 when it has
    none), so the result has groups x categories rows.  One aggregate per
    (group, category), combined map-side, feeds all of it: its totals per
    group are spread over the domain (one scalar array) and joined back to
    the counts.  As in SQL, a NULL category gets its grid row but never
    matches a member (count 0), and members with a NULL category do not enter
    the total.  Returns (group, category, name) with ``name`` as decimal(5,2).
    """
    counts = df.groupBy(group, category).agg(F.count(member).alias("__n"))
    domain = counts.agg(
        F.concat(
            F.array_sort(F.collect_set(category)),
            F.when(F.count_if(F.col(category).isNull()) > 0, F.array(F.lit(None))).otherwise(F.array()),
        )
    ).scalar()
    totals = counts.groupBy(group).agg(F.sum(F.when(F.col(category).isNotNull(), F.col("__n"))).alias("__total"))
    grid = totals.select(group, "__total", F.explode(domain).alias(category))
    held = counts.select(F.col(group).alias("__group"), F.col(category).alias("__category"), "__n")
    joined = grid.join(held, F.col(group).eqNullSafe(F.col("__group")) & (F.col(category) == F.col("__category")), "left")
    pct = F.round(F.try_divide(F.coalesce("__n", F.lit(0)) * F.lit(100.0), F.col("__total")), 2)
    return joined.select(group, category, pct.cast("decimal(5,2)").alias(name))
