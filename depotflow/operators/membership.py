"""Subqueries as joins: membership, its negation, and matches on inequality."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.session import frozen


def only_in(
    df: DataFrame, other: DataFrame, on: str | list[str], unique: bool = False, measured: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``.

    The keys of ``other`` are reduced before they meet ``df``; where they are unique in it already
    (a dimension), ``unique`` saves that shuffle. ``measured`` writes the keys first, so that Spark
    knows their size and does not shuffle a large ``df`` for a short list.
    """
    keys = [on] if isinstance(on, str) else on
    wanted = other.select(*keys) if unique else other.select(*keys).distinct()
    return df.join(frozen(wanted) if measured else wanted, keys, "left_semi")


def where_exists(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """The correlated spelling of ``only_in``, with the keys of ``other`` reduced in the same way.

    Without that step the inner rows would be shuffled as they are, a hot key into one task.
    """
    # Another name for the outer key keeps it from being found in the inner table.
    outer = df.withColumnRenamed(on, "_outer")
    # Grouping, unlike DISTINCT, is not optimised away below EXISTS.
    keys = other.groupBy(on).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 0")
    found = outer.filter(keys.where(F.col(on) == F.col("_outer").outer()).exists())
    return found.withColumnRenamed("_outer", on)


def not_matched(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` without a match in ``other``; a NULL key matches nothing."""
    keys = [on] if isinstance(on, str) else on
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """``column NOT IN (listed)``: a NULL in the list empties the result, an empty list keeps all.

    Spark plans the SQL form as a broadcast of the whole list. Here the two special cases are
    one-row subqueries and the rest is an ordinary anti-join on reduced keys.
    """
    keys = listed.select(F.col(listed_column).alias("_key")).distinct()
    facts = keys.agg(F.count("*").alias("n"), F.count_if(F.col("_key").isNull()).alias("nulls"))
    list_is_empty = facts.select(F.col("n") == 0).scalar()
    list_has_null = facts.select(F.col("nulls") > 0).scalar()
    rows = df.filter(~list_has_null & (F.col(column).isNotNull() | list_is_empty))
    return rows.join(keys, F.col(column) == F.col("_key"), "left_anti")


class Level(NamedTuple):
    """One level of a nested IN: a table, the key it is asked for, and the rest as in ``only_in``."""

    table: DataFrame
    key: str
    unique: bool = False
    measured: bool = False


def in_cascade(df: DataFrame, *levels: Level) -> DataFrame:
    """Nested IN, from the outer level to the inner one."""
    *outer, inner = levels
    for level in reversed(outer):
        inner = level._replace(table=only_in(level.table, *inner))
    return only_in(df, *inner)


def count_unequal(df: DataFrame, other: DataFrame, on: str, name: str) -> DataFrame:
    """How many rows of ``other`` have another, known key: all known ones less the equal ones.

    This is the size of the join on ``<>`` for each row, without building its pairs.
    """
    equal = other.groupBy(on).agg(F.count(on).alias("_equal"))
    known = other.agg(F.count(on)).scalar()
    counted = df.join(equal, on, "left")
    unequal = known - F.coalesce("_equal", F.lit(0))
    return counted.withColumn(name, F.when(F.col(on).isNotNull(), unequal).otherwise(0)).drop("_equal")


def product_size(*tables: DataFrame) -> Column:
    """Number of rows of the cartesian product, from one count per table."""
    size: Column = F.lit(1).cast("decimal(38,0)")
    for table in tables:
        size = (size * table.agg(F.count("*").cast("decimal(19,0)")).scalar()).cast("decimal(38,0)")
    return size
