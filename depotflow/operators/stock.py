"""Stock levels kept in step with the deliveries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from depotflow.session import frozen


def stock_delta(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Change of stock for each part: what came less what went.

    An update counts as both: its old rows are deleted, its new ones inserted. All rows of a
    part are added up, and they are added up on each task before they are shuffled.
    """
    signed = []
    if inserted is not None:
        signed.append(inserted.select("anr", F.col("lmenge").cast("long").alias("menge")))
    if deleted is not None:
        signed.append(deleted.select("anr", (-F.col("lmenge").cast("long")).alias("menge")))
    if not signed:
        raise ValueError("inserted or deleted rows expected")
    changes = signed[0] if len(signed) == 1 else signed[0].union(signed[1])
    return changes.groupBy("anr").agg(F.sum("menge").alias("menge"))


KINDS = ("Insert", "Delete")


def split_changes(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes that can be booked, and the rest with ``grund``: another kind, no part, or no quantity."""
    known = F.col("was").isin(*KINDS)
    reason = F.when(F.col("was").isNull() | ~known, "was").when(F.col("anr").isNull(), "anr").when(
        F.col("lmenge").isNull(), "lmenge")
    judged = changes.withColumn("grund", reason)
    return judged.filter("grund IS NULL").drop("grund"), judged.filter("grund IS NOT NULL")


def delta_of_changes(changes: DataFrame) -> DataFrame:
    """The same for a mixed feed with ``was``, Insert or Delete, in one pass over it.

    The rows are those that ``split_changes`` lets through; any other stops the job.
    """
    amount = F.col("lmenge").cast("long")
    signed = F.when(F.col("was") == "Insert", amount).when(F.col("was") == "Delete", -amount)
    stop = F.raise_error(F.concat(F.lit("no stock change: "), F.to_json(F.struct("was", "anr", "lmenge"))))
    booked = F.when(F.col("anr").isNotNull() & signed.isNotNull(), signed).otherwise(stop.cast("long"))
    return changes.select("anr", booked.alias("menge")).groupBy("anr").agg(F.sum("menge").alias("menge"))


def apply_delta(parts: DataFrame, delta: DataFrame) -> DataFrame:
    """The next version of the part table; unknown stock stays unknown.

    Stock becomes a BIGINT, so that no part's total stops the others; the stock rule is checked afterwards.
    """
    level = F.col("amenge").cast("long") + F.coalesce("menge", F.lit(0))
    return parts.join(delta, "anr", "left").withColumn("amenge", level).select(*parts.columns)


def maintain_stock(
    parts: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None
) -> DataFrame:
    return apply_delta(parts, stock_delta(inserted, deleted))


# The stock a part may have.
LOWEST, HIGHEST = 0, 10000


def outside(low: int = LOWEST, high: int = HIGHEST) -> Column:
    """Parts whose stock breaks the rule; unknown stock does not."""
    return ~F.col("amenge").between(low, high)


def checked_stock(
    parts: DataFrame, delta: DataFrame, low: int = LOWEST, high: int = HIGHEST
) -> tuple[DataFrame, DataFrame]:
    """The part table after a change, and the changed parts that break the stock rule.

    The rule is checked after the whole change. If any part breaks it, nothing is changed: the table is the old one. The
    new levels of the changed parts are written once, so that check and result see the same.
    """
    changed = frozen(apply_delta(parts.join(delta.select("anr"), "anr", "left_semi"), delta))
    broken = changed.filter(outside(low, high))
    if broken.limit(1).count():
        return parts.withColumn("amenge", F.col("amenge").cast("long")), broken
    level = changed.select(F.col("anr").alias("_anr"), F.col("amenge").alias("_amenge"), F.lit(True).alias("_new"))
    new = parts.join(level, F.col("anr") == F.col("_anr"), "left").withColumn(
        "amenge", F.when(F.col("_new"), F.col("_amenge")).otherwise(F.col("amenge").cast("long")))
    return new.select(*parts.columns), broken


def guarded_changes(
    parts: DataFrame, changes: DataFrame, order: str, low: int = LOWEST, high: int = HIGHEST
) -> tuple[DataFrame, DataFrame]:
    """Changes in their order, those that leave the stock rule kept, and those that do not.

    Both have ``stand``, the level that the change met. A refused change does not count for those behind it. Parts with
    unknown stock, and parts that the table lacks, take every change. Changes of a part that share their ``order`` follow
    each other by amount, the largest removal first, so a rerun judges alike.

    Parts whose running sums all keep the rule, nearly all of them, need Spark's window only. The others are folded in
    order by tasks that hold one level at a time, however many changes a part has.
    """
    amount = F.when(F.col("was") == "Insert", F.col("lmenge").cast("long")).otherwise(-F.col("lmenge").cast("long"))
    start = parts.select("anr", F.col("amenge").cast("long").alias("_start"))
    earlier = Window.partitionBy("anr").orderBy(order, "_amount").rowsBetween(Window.unboundedPreceding, -1)
    met = F.col("_start") + F.coalesce(F.sum("_amount").over(earlier), F.lit(0))
    placed = frozen(changes.withColumn("_amount", amount).join(start, "anr", "left").withColumn("stand", met))
    breaks = ~(F.col("stand") + F.col("_amount")).between(low, high)
    tight = frozen(placed.filter(breaks).select("anr").distinct())
    calm = placed.join(tight, "anr", "left_anti").withColumn("_held", F.lit(True))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, level = None, 0
        for batch in batches:
            held, levels = [], []
            for name, begin, step in zip(*(batch.column(c).to_pylist() for c in ("anr", "_start", "_amount")), strict=True):
                if name != part:
                    part, level = name, begin
                keeps = low <= level + step <= high
                held.append(keeps)
                levels.append(level)
                level += step if keeps else 0
            at = batch.schema.get_field_index("stand")
            columns = [pa.array(levels, pa.int64()) if n == at else c for n, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(held, pa.bool_())], [*batch.schema.names, "_held"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    ordered = placed.join(tight, "anr", "left_semi").repartition("anr").sortWithinPartitions("anr", order, "_amount")
    judged = frozen(calm.unionByName(ordered.mapInArrow(fold, f"{schema}, _held boolean")))
    names = [*changes.columns, "stand"]
    return judged.filter("_held").select(*names), judged.filter(~F.col("_held")).select(*names)
