"""Sub-totals over several keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _level_sums(df: DataFrame, keys: list[str], value: str, name: str, how: str) -> DataFrame:
    # Summing once by all keys first keeps the copies that each level needs small.
    base = df.groupBy(*keys).agg(F.sum(value).alias(name))
    grouped = base.rollup(*keys) if how == "rollup" else base.cube(*keys)
    return grouped.agg(F.sum(name).alias(name), F.grouping_id().cast("int").alias("ebene"))


def rollup_sum(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Sums for each prefix of the keys; ``ebene`` has a bit set for each key that is summed over."""
    return _level_sums(df, keys, value, name, "rollup")


def cube_sum(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Sums for each subset of the keys; ``ebene`` as in ``rollup_sum``."""
    return _level_sums(df, keys, value, name, "cube")


#: Logarithm of the cells of a sketch; 4,096 cells err by 1.6 % (one standard deviation).
CELLS = 12


def level_distinct(df: DataFrame, keys: list[str], value: str, name: str, how: str = "rollup", cells: int = CELLS) -> DataFrame:
    """Estimated numbers of distinct values for each prefix (``cube``: subset) of the keys, from mergeable sketches.

    The rows are read once into one sketch for each full key; every coarser level unites sketches, so neither rows nor
    values are copied for the levels. Exact counts are ``countDistinct``; this is for those who choose the error, which
    is about 1.04 / sqrt(2 ** cells), one standard deviation. Nulls are no value; ``ebene`` as in ``rollup_sum``.
    """
    base = df.groupBy(*keys).agg(F.hll_sketch_agg(value, cells).alias("sketch"))
    grouped = base.rollup(*keys) if how == "rollup" else base.cube(*keys)
    united = grouped.agg(F.hll_union_agg("sketch").alias("sketch"), F.grouping_id().cast("int").alias("ebene"))
    return united.select(*keys, F.hll_sketch_estimate("sketch").alias(name), "ebene")
