"""Distinct counts that can be merged: exact bitmaps of integer ids.

``count(DISTINCT id)`` per day can't be added up over days.  A bitmap of the
ids can be joined with others by OR, so days, dimensions and subtotals come
from one small table, and several distinct counts of one pass need no
copies of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, keys: list[Column], value: Column) -> DataFrame:
    """(keys, bucket, ids): per key and bucket of 32,768 integer ids, a bitmap of those that occur.

    One map-side combined aggregate.  A bucket's bitmap has 4 KB, so ids
    should be dense, as serial numbers are.  NULL ids are left out, and with
    them keys that have no other.
    """
    rows = df.select(*keys, value.alias("__id")).filter(F.col("__id").isNotNull())
    names = [c for c in rows.columns if c != "__id"]
    return rows.groupBy(*names, F.bitmap_bucket_number("__id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias("ids")
    )


def merged_counts(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, name): the number of distinct ids of ``id_bitmaps`` rows with equal keys, whatever else tells them apart."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(name))
