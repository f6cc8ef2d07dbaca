"""Number expressions."""

from __future__ import annotations

import random

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole_division(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Division of integers that drops the fraction: 5 by 2 is 2."""
    return F.call_function("div", _col(left), _col(right))


def whole_average(value: ColumnOrName) -> Column:
    """Average of an integer column with the fraction dropped."""
    return F.call_function("div", F.sum(_col(value)), F.count(_col(value)))


def kilograms(grams: ColumnOrName) -> Column:
    return _col(grams) * F.lit("0.001").cast("decimal(4,3)")


def statement_random(seed: int | None = None) -> Column:
    """One random number from 0 to 1 for the whole query."""
    return F.lit(random.Random(seed).random())


def ratio(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Quotient of two numbers, each 1 when missing; NULL for a zero divisor."""
    divisor = F.coalesce(_col(right).cast("double"), F.lit(1.0))
    return F.coalesce(_col(left).cast("double"), F.lit(1.0)) / F.nullif(divisor, F.lit(0.0))


# Fixed value: status of a division by zero.
ZERO_DIVISOR = 8


def ratio_status(right: ColumnOrName) -> Column:
    """0 for a usable divisor, 8 for zero."""
    return F.when(_col(right) == 0, ZERO_DIVISOR).otherwise(0)
