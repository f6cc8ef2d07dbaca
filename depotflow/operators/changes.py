"""Table changes: each job reads one version of a table and returns the next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.operators.membership import not_matched
from depotflow.operators.numbering import number_rows
from depotflow.session import frozen


def aligned(rows: DataFrame, like: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """``rows`` with the columns and types of ``like``.

    A column that is absent gets its default, or NULL; a NULL that is given stays NULL.
    """
    unknown = [name for name in rows.columns if name not in like.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    defaults = defaults or {}
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
        for f in like.schema.fields
    ])


def insert(table: DataFrame, rows: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    return table.unionByName(aligned(rows, table, defaults))


def insert_by_position(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Columns are taken in table order, whatever their names; every column must be there."""
    if len(rows.columns) != len(table.columns):
        raise ValueError(f"{len(table.columns)} columns expected, {len(rows.columns)} given")
    return insert(table, rows.toDF(*table.columns))


def insert_numbered(table: DataFrame, rows: DataFrame, key: str, order: list[Column], first: int = 1000) -> DataFrame:
    """Insert rows that get the next numbers, from ``first`` on in an empty table.

    Columns that only give the order stay behind.
    """
    last = table.agg(F.coalesce(F.max(key), F.lit(first - 1))).scalar()
    numbered = number_rows(rows, order, "_next").withColumn(key, F.col("_next") + last)
    return insert(table, numbered.select(*[name for name in table.columns if name in numbered.columns]))


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def update(table: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """New values where the condition is true; all of them see the old row."""
    types = {f.name: f.dataType for f in table.schema.fields}
    return table.withColumns({
        name: F.when(_holds(condition), value.cast(types[name])).otherwise(F.col(name))
        for name, value in values.items()
    })


def update_members(table: DataFrame, keys: DataFrame, on: str, **values: Column) -> DataFrame:
    """New values for the rows whose key occurs in ``keys``."""
    marked = table.join(keys.select(on).distinct().withColumn("_member", F.lit(True)), on, "left")
    return update(marked, F.col("_member"), **values).select(*table.columns)


def delete(table: DataFrame, condition: Column) -> DataFrame:
    return table.filter(~_holds(condition))


def delete_unmatched(table: DataFrame, other: DataFrame, on: str, spared: Column) -> DataFrame:
    """Keep the rows that occur in ``other`` and those that are spared in any case."""
    marked = table.join(other.select(on).distinct().withColumn("_known", F.lit(True)), on, "left")
    return marked.filter(F.col("_known") | _holds(spared)).select(*table.columns)


def truncate(table: DataFrame) -> DataFrame:
    return table.limit(0)


def cascade_key(table: DataFrame, renamed: DataFrame, on: str) -> DataFrame:
    """Follow changed keys; ``renamed`` holds one row (``old``, ``new``) for each of them.

    A key that ``renamed`` has with two new values stops the job; so no row is multiplied.
    """
    one = renamed.groupBy("old").agg(F.min("new").alias("new"), F.max("new").alias("_other"))
    stop = F.raise_error(F.concat(F.lit("two new keys for "), F.col("old").cast("string")))
    kind = renamed.schema["new"].dataType
    one = one.select("old", F.when(F.col("new").eqNullSafe(F.col("_other")), F.col("new")).otherwise(
        stop.cast(kind)).alias("new"))
    return (
        table.join(one, F.col(on) == F.col("old"), "left")
        .withColumn(on, F.coalesce("new", on))
        .select(*table.columns)
    )


def checked_cascade(table: DataFrame, renamed: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """The table with changed keys, and the new keys that would not be unique in it.

    The change is judged as a whole, as a primary key does: keys may swap, but if any new key is one that a row keeps, or
    that another row takes, nothing is changed. ``table`` has one row for each key; names of keys that it lacks are
    left aside. Only the keys that change, and those they meet, are shuffled.
    """
    one = frozen(renamed.select("old", "new").filter(~F.col("old").eqNullSafe(F.col("new"))).distinct().join(
        table.select(F.col(on).alias("old")), "old", "left_semi"))
    kept = table.select(F.col(on).alias("new")).join(one.select("new").distinct(), "new", "left_semi").join(
        one.select(F.col("old").alias("new")), "new", "left_anti")
    twice = one.groupBy("new").agg(F.count("*").alias("_n")).filter("_n > 1").select("new")
    split = one.groupBy("old").agg(F.count("*").alias("_n")).filter("_n > 1").join(one, "old").select("new")
    taken = frozen(kept.union(twice).union(split).distinct().withColumnRenamed("new", on))
    if taken.limit(1).count():
        return table, taken
    return cascade_key(table, one, on), taken


def add_column(table: DataFrame, name: str, kind: str) -> DataFrame:
    return table.withColumn(name, F.lit(None).cast(kind))


def retype_column(table: DataFrame, name: str, kind: str) -> DataFrame:
    return table.withColumn(name, F.col(name).cast(kind))


def count_each(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and number of rows of every table, as one job."""
    counts = [
        df.agg(F.count("*").alias("anzahl_datensaetze")).select(F.lit(name).alias("tabellenname"), "anzahl_datensaetze")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.union(part)
    return result


# --- changes through a view -------------------------------------------------------------------


def split_by_view(rows: DataFrame, visible: Column) -> tuple[DataFrame, DataFrame]:
    """Rows the view can show, and the rest, which a checked view refuses."""
    return rows.filter(_holds(visible)), rows.filter(~_holds(visible))


def update_through_view(table: DataFrame, visible: Column, condition: Column, **values: Column) -> DataFrame:
    return update(table, visible & condition, **values)


def checked_view_update(
    table: DataFrame, visible: Column, condition: Column, **values: Column
) -> tuple[DataFrame, DataFrame]:
    """The updated table, and the changed rows the view could no longer show.

    A row in the second result keeps its old values in the first.
    """
    before = table.withColumn("_old", F.struct(*table.columns)).withColumn("_hit", _holds(visible & condition))
    after = update(before, F.col("_hit"), **values).withColumn("_lost", F.col("_hit") & ~_holds(visible))
    kept = [F.when(F.col("_lost"), F.col(f"_old.{name}")).otherwise(F.col(name)).alias(name) for name in table.columns]
    return after.select(*kept), after.filter("_lost").select(*table.columns)


def delete_through_view(table: DataFrame, visible: Column, other: DataFrame, on: str) -> DataFrame:
    """Delete the visible rows that have no match in ``other``."""
    return delete_unmatched(table, other, on, spared=~_holds(visible))


# --- feeds ------------------------------------------------------------------------------------


def route_joined_feed(
    feed: DataFrame, dimension: DataFrame, fact: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Split rows of a joined view into new dimension rows and fact rows.

    Each key that the dimension lacks is added once; every row of the feed becomes a fact.
    """
    # The feed repeats a description with every fact; the repeats go before anything is shuffled.
    described = feed.select(*dimension.columns).distinct()
    rest = [name for name in dimension.columns if name != key]
    # Of several descriptions of a key the smallest is taken, whichever task sees it first.
    fresh = not_matched(described, dimension, key).groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return fresh.select(key, "_row.*").select(*dimension.columns), feed.select(*fact.columns)


def refuse_all(rows: DataFrame, reason: str) -> DataFrame:
    return rows.withColumn("grund", F.lit(reason))
