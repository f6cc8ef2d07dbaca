"""Relational division: who is related to every element of a set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from depotflow.operators.numbering import number_rows
from depotflow.session import frozen


def divide(pairs: DataFrame, candidate: str, element: str, wanted: DataFrame) -> DataFrame:
    """Candidates paired with every ``element`` of ``wanted``; all candidates if it is empty.

    The wanted elements are written and counted first, so that Spark knows their size. Pairs with
    other elements are dropped before the rest is reduced and counted.
    """
    elements = frozen(wanted.select(element).distinct())
    size = elements.count()
    if size == 0:
        return pairs.select(candidate).distinct()
    return (
        pairs.select(candidate, element).join(elements, element, "left_semi")
        .groupBy(candidate).agg(F.countDistinct(element).alias("_covered"))
        .filter(F.col("_covered") == size)
        .select(candidate)
    )


def covers_all_of(pairs: DataFrame, candidate: str, element: str, model) -> DataFrame:
    """Other candidates that are paired with everything ``model`` is paired with."""
    wanted = pairs.filter(F.col(candidate) == F.lit(model))
    return divide(pairs, candidate, element, wanted).filter(F.col(candidate) != F.lit(model))


def with_every(pairs: DataFrame, candidate: str, element: str, table: DataFrame) -> DataFrame:
    """Candidates with as many different elements as ``table`` has rows.

    Right where every element comes from ``table``, as a foreign key declares; no join is needed.
    """
    size = table.agg(F.count("*")).scalar()
    return (
        pairs.groupBy(candidate).agg(F.countDistinct(element).alias("_covered"))
        .filter(F.col("_covered") == size)
        .select(candidate)
    )


#: Bits of one word of a candidate's set; the top bit stays free, so that a word is never negative.
WORD_BITS = 63


def divide_by_bits(pairs: DataFrame, candidate: str, element: str, wanted: DataFrame) -> DataFrame:
    """What ``divide`` returns, with every candidate's elements as a set of bits.

    The wanted elements are numbered without gaps, and a pair sets one bit of one word of its candidate. Words combine
    before the shuffle, so a task sends one row for each candidate and word, whatever the number of its pairs or of
    their repetitions: a row for up to 63 elements instead of a row for each. The words are fixed-width numbers, which
    Spark aggregates by hash. A NULL among the wanted elements is covered by nobody.
    """
    elements = number_rows(wanted.select(F.col(element).alias("_element")).distinct(), [F.col("_element")], "_nr", 0)
    elements = frozen(elements)
    size = elements.count()
    if size == 0:
        return pairs.select(candidate).distinct()
    place = F.pmod("_nr", F.lit(WORD_BITS)).cast("int")
    return (
        pairs.join(elements, F.col(element) == F.col("_element"))
        .select(candidate, F.expr(f"_nr div {WORD_BITS}").alias("_word"), F.call_function(
            "shiftleft", F.lit(1).cast("long"), place).alias("_bit"))
        .groupBy(candidate, "_word").agg(F.bit_or("_bit").alias("_bits"))
        .groupBy(candidate).agg(F.sum(F.bit_count("_bits")).alias("_covered"))
        .filter(F.col("_covered") == size)
        .select(candidate)
    )


def covers_all_of_by_bits(pairs: DataFrame, candidate: str, element: str, model) -> DataFrame:
    """What ``covers_all_of`` returns, with sets of bits."""
    wanted = pairs.filter(F.col(candidate) == F.lit(model))
    return divide_by_bits(pairs, candidate, element, wanted).filter(F.col(candidate) != F.lit(model))
