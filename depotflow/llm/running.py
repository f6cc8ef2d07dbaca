"""Running sums over groups of any size: no group is ever one task's.

Rows are ordered inside their group by a hash written as hexadecimal text. Its first digits cut every group into
buckets; bucket totals are summed up first, and a window then runs inside single buckets only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

DIGITS = 3


def with_starts(rows: DataFrame, group: str, order: str, value: str, more: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``start``, the sum of ``value`` over the rows before in the group, and ``place`` in the bucket.

    ``group`` holds no null. ``more`` has further columns per group; it joins the bucket totals, not the rows. Rows
    that share the whole order follow each other in any order, so they should be alike in every column.
    """
    keyed = rows.withColumn("bucket", F.substring(order, 1, DIGITS))
    totals = keyed.groupBy(group, "bucket").agg(F.sum(value).alias("bucket_total"))
    before = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(group, "bucket", F.coalesce(F.sum("bucket_total").over(before), F.lit(0)).alias("offset"))
    if more is not None:
        totals = totals.join(more, group)
    inside = Window.partitionBy(group, "bucket").orderBy(order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(totals, [group, "bucket"])
        .withColumn("start", F.col("offset") + F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        .withColumn("place", F.row_number().over(inside))
        .drop("offset")
    )
