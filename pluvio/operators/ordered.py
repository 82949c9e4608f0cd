"""Running sums over an order that no single task sees whole.

Rows are dealt by range of (group, order), so a group that holds a third of all rows
lies in many ranges. Every range sums up its own rows; the totals, one row per range
and group, become exclusive offsets; the running sum starts from the range's offset.
The work grows with the rows, whatever the number of ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.session import persist_table


def meets(left: Sequence[str], prefix: str) -> Column:
    """Condition under which rows of one key meet, null keys included; the right
    side's columns carry ``prefix``."""
    on = F.lit(True)
    for c in left:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return on


def ranged(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column],
           ranges: int | None = None, part: str = "__part") -> DataFrame:
    """Rows in ascending ranges of (groups, order), ``part`` being the range's number,
    written to the shared folder: the sample that cuts the ranges is taken once, and
    every later step sees the same ranges. ``ranges`` follows the session's shuffle
    partitions; it has no bearing on results."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *groups, *order).withColumn(part, F.spark_partition_id())
    return persist_table(rows, "ranges")


def sums_before(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column],
                sums: Mapping[str, Column | str], totals: bool = False,
                ranges: int | None = None) -> DataFrame:
    """``df`` with, for every entry of ``sums``, the sum of its column over the rows of
    the same groups that come earlier in ``order``; with ``totals``, also
    ``total_<name>`` over all rows of the groups. Null group keys are a group; rows
    that tie in ``order`` are taken in any order, so the order should settle all ties
    that matter. An empty table stays empty."""
    g = list(groups)
    value = {k: F.col(v) if isinstance(v, str) else v for k, v in sums.items()}
    rows = ranged(df.select("*", *[c.alias(f"__v_{k}") for k, c in value.items()]), g, order, ranges)
    part = rows.groupBy("__part", *g).agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in value])
    # at most one row per range in a group's window
    earlier = Window.partitionBy(*g).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offset = [F.coalesce(F.sum(f"__t_{k}").over(earlier), F.lit(0)).alias(f"__o_{k}") for k in value]
    if totals:
        offset += [F.sum(f"__t_{k}").over(Window.partitionBy(*g)).alias(f"total_{k}") for k in value]
    offsets = part.select(F.col("__part").alias("__at___part"), *[F.col(c).alias(f"__at_{c}") for c in g], *offset)
    inside = Window.partitionBy("__part", *g).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", *[F.coalesce(F.sum(f"__v_{k}").over(inside), F.lit(0)).alias(f"__i_{k}") for k in value])
    joined = rows.join(offsets, meets(["__part", *g], "__at_"))
    return joined.select(*df.columns, *[(F.col(f"__o_{k}") + F.col(f"__i_{k}")).alias(k) for k in value],
                         *([F.col(f"total_{k}") for k in value] if totals else []))
