"""Numbering and ranking of whole tables without putting all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from depotflow.session import frozen

# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in the given order; rows that it leaves equal are numbered in any order.

    One range shuffle sorts the table; each row then knows its partition and its place in it.
    The sorted rows are written once, because a second range shuffle could draw other bounds.
    What the window sees is one row per partition. The row's place in the source is the last sort
    key, so that many equal rows spread over tasks.
    """
    placed = frozen(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, F.col("_tie"))
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.coalesce(
        F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("_part", before.alias("_before"))
    local = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + local + start)
        .drop("_part", "_before", "_place")
    )


def rank_values(df: DataFrame, value: str, descending: bool = True) -> DataFrame:
    """Add ``rang`` (gaps after ties) and ``rang_dicht`` (no gaps) by ``value``.

    Ties are counted before anything is sorted, so a value that many rows share stays one row.
    A bucket is one range partition; the window runs inside buckets.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    tied = frozen(
        df.groupBy(value).agg(F.count("*").alias("_ties"))
        .repartitionByRange(order)
        .withColumn("_bucket", F.spark_partition_id())
    )
    by_bucket = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tied.groupBy("_bucket").agg(F.sum("_ties").alias("_rows"), F.count("*").alias("_values"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_rows").over(by_bucket), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_values").over(by_bucket), F.lit(0)).alias("_values_before"),
        )
    )
    inside = Window.partitionBy("_bucket").orderBy(order)
    earlier = F.coalesce(F.sum("_ties").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = tied.join(F.broadcast(offsets), "_bucket").select(
        F.col(value).alias("_value"),
        (F.col("_rows_before") + earlier + 1).alias("rang"),
        (F.col("_values_before") + F.row_number().over(inside)).alias("rang_dicht"),
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
