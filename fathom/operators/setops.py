"""Set operations with SQL semantics (positional, DISTINCT unless ALL)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def _check_width(frames: tuple[DataFrame, ...]) -> None:
    widths = {len(f.columns) for f in frames}
    if len(widths) != 1:
        raise ValueError(f"set operation over inputs of different widths: {sorted(widths)}")


def union_all(*frames: DataFrame) -> DataFrame:
    """``UNION ALL``: by position, names from the first input, duplicates kept."""
    _check_width(frames)
    return reduce(DataFrame.union, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``UNION``: one hash aggregate over all inputs (partial per input first)."""
    return union_all(*frames).distinct()


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """``INTERSECT``: NULLs compare equal; planned as a null-safe semi join."""
    _check_width((left, right))
    return left.intersect(right)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """``EXCEPT`` (DISTINCT): ``subtract``, not ``exceptAll``."""
    _check_width((left, right))
    return left.subtract(right)
