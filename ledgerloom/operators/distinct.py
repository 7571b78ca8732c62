"""Exact distinct counts that can be added up: one bitmap for each group, merged over months, categories or anything else.

Values are numbered once. A group's bitmap has a bit for each number, in buckets of fixed size, so it is a few kilobytes
however many rows the group has, and the bitmap of a larger group is the union of those of its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import numbered


def numbers_of(values: DataFrame, column: str) -> DataFrame:
    """Distinct values (blanks and nulls left out) with their number from 0."""
    known = values.select(column).filter(F.col(column) != "").distinct()
    return numbered(known, [F.col(column)], "_no").withColumn("_no", F.col("_no") - 1)


def bitmaps(df: DataFrame, keys: list[str], column: str, numbers: DataFrame) -> DataFrame:
    """(keys, ``bucket``, ``bits``): the values that each group holds. Tasks reduce their rows to distinct values first."""
    held = df.select(*keys, column).distinct().join(numbers, column)
    return held.groupBy(*keys, F.bitmap_bucket_number("_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_no")).alias("bits"))


def merged(bits: DataFrame, keys: list[Column]) -> DataFrame:
    """The bitmaps of larger groups, from those of their parts."""
    return bits.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bit_counts(bits: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The number of distinct values of each group."""
    return bits.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
