"""Where results go: tables, session views, report files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.session import frozen


def into_table(df: DataFrame, name: str) -> DataFrame:
    """Result as a new table; fails if the table is there."""
    df.write.mode("errorifexists").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def append_to_table(df: DataFrame, name: str) -> None:
    """Add rows to a table, column by position."""
    df.write.insertInto(name)


def into_folder(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_to_folder(df: DataFrame, path: str) -> DataFrame:
    """Add rows to a stored table, column by position."""
    stored = df.sparkSession.read.parquet(path)
    df.toDF(*stored.columns).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def into_session_view(df: DataFrame, name: str) -> DataFrame:
    """Snapshot of the result, for this session only."""
    snapshot = frozen(df)
    snapshot.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def into_shared_view(df: DataFrame, name: str) -> DataFrame:
    """Snapshot of the result, for all sessions of the application."""
    snapshot = frozen(df)
    snapshot.createOrReplaceGlobalTempView(name)
    return df.sparkSession.table(f"global_temp.{name}")


def publish_if(df: DataFrame, path: str, broken: Callable[[DataFrame], Column]) -> DataFrame | None:
    """Write a new version, check what was written, and hand it out only if no row is broken.

    Readers keep the old version until then; a version that fails is never named to them.
    """
    staged = into_folder(df, path)
    return None if staged.filter(broken(staged)).limit(1).count() else staged


def xml_elements(row_tag: str, *columns: str) -> Column:
    """One row as an element with one child for each known value."""
    return F.rtrim(F.to_xml(F.struct(*columns), {"rowTag": row_tag, "indent": ""}), F.lit("\n"))


def write_xml_report(df: DataFrame, path: str, row_tag: str) -> None:
    df.select(xml_elements(row_tag, *df.columns).alias("value")).write.text(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)
