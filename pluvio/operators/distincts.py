"""Exact distinct counts that add up over parts.

A distinct count of one part says nothing about the next, so a count over appended data
would read everything again. Here each part keeps, per range of 32,768 consecutive whole
numbers, one bitmap of the values that occur. Bitmaps of files, days or months are merged
by OR, and a count is the number of set bits. The state grows with the ranges that hold a
value (4 KB each), not with rows, so keys should be dense (ids from a sequence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, value: str, part: str) -> DataFrame:
    """(part, faixa, bits): bitmaps of the whole-number column ``value`` per ``part``.
    NULL values do not count; a part with none has no row. Partial bitmaps are built
    before the shuffle, so a hot part or value is one row per task and range."""
    v = F.col(value).cast("bigint")
    return (df.where(v.isNotNull()).groupBy(F.col(part), F.bitmap_bucket_number(v).alias("faixa"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bits")))


def merge_bitmaps(bitmaps: DataFrame, part: Column, name: str) -> DataFrame:
    """Bitmaps of coarser parts: ``part`` is an expression over the finer ones. Several
    files' bitmaps are merged by a union before this."""
    return bitmaps.groupBy(part.alias(name), "faixa").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, part: str) -> DataFrame:
    """(part, n): exact distinct values per part."""
    return bitmaps.groupBy(part).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("n"))
