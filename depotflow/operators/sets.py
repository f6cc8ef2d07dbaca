"""Set operations on texts that are equal whatever their letter case and trailing blanks.

Every result is a set; of several spellings of one text the first is shown. A NULL equals a NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from depotflow.functions.text import comparable


def distinct_texts(rows: DataFrame, column: str) -> DataFrame:
    """``column`` once for each text, beside ``_key``, the text as it is compared."""
    return rows.groupBy(comparable(rows, column).alias("_key")).agg(F.min(column).alias(column))


def _same(left: DataFrame, right: DataFrame, column: str, how: str) -> DataFrame:
    keys = distinct_texts(right, column).select(F.col("_key").alias("_other"))
    own = distinct_texts(left, column)
    return own.join(keys, F.col("_key").eqNullSafe(F.col("_other")), how).select(column)


def union_texts(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    # Both sides are reduced before the union, so that few rows meet in it.
    both = distinct_texts(left, column).unionByName(distinct_texts(right, column))
    return both.groupBy("_key").agg(F.min(column).alias(column)).select(column)


def except_texts(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    return _same(left, right, column, "left_anti")


def intersect_texts(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    return _same(left, right, column, "left_semi")
