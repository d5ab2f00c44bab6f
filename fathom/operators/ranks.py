"""Average ranks of a whole table, and two-sample statistics from them and from exact sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.operators.windows import prefix_sums


def value_ranks(df: DataFrame, value: str, group: str, rows: int | None = None) -> DataFrame:
    """(value, group, n, tied, twice_rank): the average rank that n rows of a group share with all ties.

    ``twice_rank`` is twice the average rank (1 is the least value), a whole
    number.  Rows are counted per value and group before anything is ordered,
    so a value of very many rows is one row; the counts of lesser values are
    prefix sums over ranges of the values.  NULL values have no rank.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value, group).agg(F.count(F.lit(1)).alias("n"))
    # As many entries as there are groups.
    per_value = counts.groupBy(value).agg(F.sum("n").alias("tied"), F.collect_list(F.struct(group, "n")).alias("__groups"))
    upto = prefix_sums(per_value, [], value, {"tied": "__upto"}, rows)
    twice = 2 * (F.col("__upto") - F.col("tied")) + F.col("tied") + 1
    return upto.select(value, "tied", twice.alias("twice_rank"), F.inline("__groups")).select(value, group, "n", "tied", "twice_rank")


def rank_sums(df: DataFrame, value: str, group: str, rows: int | None = None) -> DataFrame:
    """(group, n, twice_rank_sum, ties): per group; ``ties`` is the sum of t^3 - t over all values, in each row.

    Exact whole numbers (decimals), however large.
    """
    ranks = value_ranks(df, value, group, rows)
    big = lambda c: F.col(c).cast("decimal(19,0)")
    # A value's ties are shared out over its groups by their numbers: the parts add up to t^3 - t.
    part = (big("n") * (big("tied") * big("tied") - 1)).cast("decimal(38,0)")
    sums = ranks.groupBy(group).agg(
        F.sum("n").alias("n"),
        F.sum((big("n") * big("twice_rank")).cast("decimal(38,0)")).alias("twice_rank_sum"),
        F.sum(part).alias("__part"),
    )
    return sums.select(group, "n", "twice_rank_sum", sums.agg(F.sum("__part")).scalar().alias("ties"))


def rank_sum_z(n1: Column, n2: Column, twice_rank_sum: Column, ties: Column) -> Column:
    """The rank-sum (Mann-Whitney) statistic of the first group, standardised, with the correction for ties."""
    n1, n2, r, t = (c.cast("double") for c in (n1, n2, twice_rank_sum, ties))
    n = n1 + n2
    u = r / 2 - n1 * (n1 + 1) / 2
    spread = n1 * n2 / 12 * ((n + 1) - F.try_divide(t, n * (n - 1)))
    return F.try_divide(u - n1 * n2 / 2, F.sqrt(spread))


def sample_variance(n: Column, total: Column, squares: Column) -> Column:
    """From the number of values, their exact sum and their exact sum of squares."""
    n, total, squares = (c.cast("double") for c in (n, total, squares))
    return F.try_divide(squares - F.try_divide(total * total, n), n - 1)


def welch(n1: Column, mean1: Column, var1: Column, n2: Column, mean2: Column, var2: Column) -> tuple[Column, Column]:
    """Welch's t and its degrees of freedom, for two samples of different variances."""
    n1, n2 = n1.cast("double"), n2.cast("double")
    a, b = F.try_divide(var1, n1), F.try_divide(var2, n2)
    t = F.try_divide(mean1 - mean2, F.sqrt(a + b))
    df = F.try_divide((a + b) * (a + b), F.try_divide(a * a, n1 - 1) + F.try_divide(b * b, n2 - 1))
    return t, df
