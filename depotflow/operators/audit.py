"""Audit rows of a change: one for every row it touches, whether or not a value became another."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_SHAPE = ("was", "primaerschluessel", "spalte", "neuer_wert", "alter_wert")


def _shaped(rows: DataFrame, was: str, key: str, column: Column, new: Column, old: Column) -> DataFrame:
    texts = (F.lit(was), F.col(key), column, new, old)
    return rows.select(*[value.cast("string").alias(name) for name, value in zip(_SHAPE, texts)])


def inserted(rows: DataFrame, key: str) -> DataFrame:
    """New rows; their new value is the key."""
    nothing = F.lit(None)
    return _shaped(rows, "Insert", key, nothing, F.col(key), nothing)


def deleted(table: DataFrame, condition: Column, key: str) -> DataFrame:
    """The rows that a delete takes; their old value is the key."""
    nothing = F.lit(None)
    return _shaped(table.filter(condition), "Delete", key, nothing, nothing, F.col(key))


def updated(table: DataFrame, condition: Column, key: str, **values: Column) -> DataFrame:
    """The rows that an update hits, once for each audited column, with the value before and after."""
    types = {f.name: f.dataType for f in table.schema.fields}
    images = F.array(*[
        F.struct(
            F.lit(name).alias("spalte"), value.cast(types[name]).cast("string").alias("neu"),
            F.col(name).cast("string").alias("alt"))
        for name, value in values.items()
    ])
    hit = table.filter(condition).select(key, F.explode(images).alias("_image"))
    return _shaped(hit, "Update", key, F.col("_image.spalte"), F.col("_image.neu"), F.col("_image.alt"))


def stamped(
    *changes: DataFrame, number: int, when: datetime, who: Column | None = None, columns: bool = False
) -> DataFrame:
    """Audit rows of one or more changes with number, time and user; ``columns`` keeps the column's name."""
    rows = reduce(DataFrame.unionByName, changes)
    stamp = rows.select(
        F.lit(number).alias("lfdnr"),
        F.lit(when).cast("timestamp_ntz").alias("wann"),
        (F.current_user() if who is None else who).alias("wer"),
        *_SHAPE,
    )
    return stamp if columns else stamp.drop("spalte")
