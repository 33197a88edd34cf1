"""Global row numbers without one task holding all rows.

Rows are dealt by ranges of the order, sorted inside each range and stored. A range knows its rows' places from 0;
its offset is the number of rows in the ranges before it, a running sum over one row for each range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, order: Sequence[str | Column], first: int = 1, col: str = "row_no") -> DataFrame:
    """``df`` with ``col``: first, first + 1, ... in the given order (nulls first). Equal rows get different numbers."""
    from ..session import cut_lineage
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = cut_lineage(rows.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(ranges), "_range").withColumn(col, F.col("_before") + F.col("_place") + first).drop(
        "_range", "_place", "_before")
