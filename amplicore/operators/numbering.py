"""Consecutive numbers in an order, without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amplicore.storage import stored


def numbered(df: DataFrame, order: list[Column], name: str = "row", within: list[str] | None = None) -> DataFrame:
    """df with the place of each row (from 1) in the order, or in its group's order (within; not null).

    Rows are dealt by ranges of the order and sorted there; each range's place is the sum of the ranges before it, a row for
    each range (and group). What lies in a range is written once, so that both steps see the same ranges.
    """
    own = within or []
    at = F.monotonically_increasing_id()
    ranged = stored(df.repartitionByRange(*own, *order).sortWithinPartitions(*own, *order).withColumn("__at", at).withColumn("__range", F.shiftright("__at", 33)), "numbered")
    sizes = ranged.groupBy("__range", *own).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(*own).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__range", *own, "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__at") - F.col("__first") + 1
    return ranged.join(sizes, ["__range", *own]).withColumn(name, place).select(*df.columns, name)
