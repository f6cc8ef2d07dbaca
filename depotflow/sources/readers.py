"""Sources beside the stored tables: generated rows and binary files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def text_keys(number: str | Column) -> list[Column]:
    """A number and the three text columns of the index test table made from it."""
    n = F.col(number) if isinstance(number, str) else number
    text = n.cast("string")
    return [
        n.alias("id"),
        F.concat(text, F.lit("Lagerkraft")).alias("namen"),
        F.concat(F.lit("Nr_"), text).alias("vname"),
        F.concat(text, F.lit("_Halle_"), text).alias("ort"),
    ]


def generate(spark: SparkSession, rows: int = 1_000_000) -> DataFrame:
    """Rows 1 to ``rows`` of the index test table, made by all tasks at once."""
    return spark.range(1, rows + 1).select(*text_keys("id"))


def one_row(spark: SparkSession, **values: Column) -> DataFrame:
    """A query without a table."""
    return spark.range(1).select(*[value.alias(name) for name, value in values.items()])


def binary_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files as rows: path, file type, size and content. Content is read only where it is selected."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.col("path"),
        F.concat(F.lit("."), F.substring_index("path", ".", -1)).alias("typ"),
        F.col("length").alias("bytes"),
        F.col("content").alias("bild"),
    )
