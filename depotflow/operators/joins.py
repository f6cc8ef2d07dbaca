"""Joins whose plain form would put a hot key into one task or build all pairs of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from depotflow.functions import text
from depotflow.operators.membership import not_matched
from depotflow.operators.numbering import number_rows
from depotflow.session import frozen


def left_from_dimension(dimension: DataFrame, fact: DataFrame, on: str) -> DataFrame:
    """Every dimension row with its facts, NULLs where there are none.

    The matched part is an inner join, whose hot keys adaptive execution can split on the fact
    side; in a left join with the facts on the right it cannot.
    """
    matched = dimension.join(fact, on)
    lonely = not_matched(dimension, fact, on)
    return matched.unionByName(lonely, allowMissingColumns=True)


def full_outer(dimension: DataFrame, fact: DataFrame, on: str) -> DataFrame:
    """Full outer join of a dimension and a fact table, in two splittable parts.

    Where a dimension key repeats, its facts repeat with it, as in any outer join.
    """
    matched = fact.join(dimension, on, "left")
    lonely = not_matched(dimension, fact, on)
    return matched.unionByName(lonely, allowMissingColumns=True)


def partners_by_group(df: DataFrame, group: str, key: str) -> DataFrame:
    """All unordered pairs within a group, written as one row per member instead of per pair.

    ``position`` is the member's place in its group by ``key``; it forms a pair with each member
    behind it, ``partner`` of them. The numbering is global, so a hot group spreads over tasks.
    """
    members = df.filter(F.col(group).isNotNull())
    numbered = number_rows(members, [F.col(group), F.col(key)], "_number")
    groups = numbered.groupBy(group).agg(F.min("_number").alias("_first"), F.count("*").alias("_size"))
    # As a rule there are few groups; written, they have a known size, and their members stay where they are.
    groups = frozen(groups)
    position = F.col("_number") - F.col("_first") + 1
    return (
        numbered.join(groups, group)
        .withColumn("position", position)
        .withColumn("partner", F.col("_size") - position)
        .drop("_number", "_first", "_size")
    )


def count_partners(df: DataFrame, other: DataFrame, key: str, other_key: str, name: str) -> DataFrame:
    """How many rows of ``other`` each row meets in a join on a non-unique key; rows with none are left out.

    Text keys meet whatever their letter case and trailing blanks.
    """
    theirs = text.comparable(other, other_key)
    met = frozen(other.groupBy(theirs.alias("_met")).agg(F.count("*").alias(name)))
    return df.join(met, text.comparable(df, key) == F.col("_met")).drop("_met")

