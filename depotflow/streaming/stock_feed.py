"""Stock levels from a stream of delivery changes.

Each micro-batch writes the summed change of the parts it touches into a folder of its own, and the
work of a batch grows with the batch and not with the part table. A marker, an empty folder whose
name has the batch's number, says that the batch is complete; a batch that is replayed after that is
left as it is, so readers never see it half written, and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from depotflow.operators.stock import HIGHEST, LOWEST, apply_delta, delta_of_changes, guarded_changes, split_changes
from depotflow.session import remove, shared_folder

# Splits a batch into accepted and rejected rows.
Check = Callable[[DataFrame], tuple[DataFrame, DataFrame]]

_NONE = -1


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers behind the last sign of the names in a folder, which may be missing."""
    files, place = _files(spark, folder)
    if not files.exists(place):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    return sorted(int(name.rpartition("=")[2]) for name in names if "=" in name)


def _last(spark: SparkSession, folder: str, kind: str) -> int:
    return max(_numbers(spark, f"{folder}/published/{kind}"), default=_NONE)


def _publish(spark: SparkSession, folder: str, kind: str, batch: int) -> None:
    """Name a batch as complete, then drop the markers it replaces."""
    files, place = _files(spark, f"{folder}/published/{kind}/batch={batch}")
    files.mkdirs(place)
    for earlier in _numbers(spark, f"{folder}/published/{kind}"):
        if earlier < batch:
            remove(spark, f"{folder}/published/{kind}/batch={earlier}")


#: Batches after which a feed folds them into one sum.
FOLD = 100


def write_batch(changes: DataFrame, batch: int, folder: str, check: Check | None = None, fold: int = FOLD) -> None:
    """Store the change of one batch; ``changes`` has ``was`` (Insert or Delete), ``anr``, ``lmenge``.

    Rows of another kind, without part or without quantity, and what ``check`` refuses, are stored as rejects with
    their reason; all other rows count. A batch that is complete already is not written again. After ``fold`` batches
    they are folded into one, so a reader opens a bounded number of folders however long the feed runs.
    """
    spark = changes.sparkSession
    if batch <= _last(spark, folder, "deltas"):
        return
    # The source is read once; rejects and changes follow from the same rows.
    path = shared_folder(spark, "batch")
    changes.write.parquet(path)
    kept = spark.read.schema(changes.schema).parquet(path)
    booked, refused = split_changes(kept)
    refused.write.mode("overwrite").parquet(f"{folder}/rejected/batch={batch}")
    if check is not None:
        booked, failed = check(booked)
        failed.write.mode("overwrite").parquet(f"{folder}/failed/batch={batch}")
    delta_of_changes(booked).write.mode("overwrite").parquet(f"{folder}/deltas/batch={batch}")
    _publish(spark, folder, "deltas", batch)
    remove(spark, path)
    if batch - _last(spark, folder, "sums") >= fold:
        compact(spark, folder)


def stock_rule(parts: DataFrame, folder: str, order: str, low: int = LOWEST, high: int = HIGHEST) -> Check:
    """A check that refuses exactly the changes that would break the stock rule, in the order of ``order``.

    The level that a batch starts from is the part table with all complete batches applied, which is what a replay of
    the batch finds too; only the parts of the batch are looked up.
    """

    def check(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
        own = parts.join(changes.select("anr").distinct(), "anr", "left_semi")
        return guarded_changes(current_stock(parts.sparkSession, own, folder), changes, order, low, high)

    return check


def start(
    changes: DataFrame, folder: str, checkpoint: str, check: Check | None = None, **trigger: object
) -> StreamingQuery:
    """Run the feed; by default until everything that is there has been read."""
    return (
        changes.writeStream.foreachBatch(lambda df, batch: write_batch(df, batch, folder, check))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _complete(spark: SparkSession, folder: str, kind: str, after: int = _NONE) -> DataFrame | None:
    """Rows of the complete batches behind a number; None if there is none."""
    last = _last(spark, folder, "deltas")
    paths = [f"{folder}/{kind}/batch={n}" for n in _numbers(spark, f"{folder}/{kind}") if after < n <= last]
    return spark.read.parquet(*paths) if paths else None


def _summed(spark: SparkSession, folder: str) -> DataFrame | None:
    """Change of every part by all complete batches; None before the first."""
    folded = _last(spark, folder, "sums")
    parts = [_complete(spark, folder, "deltas", after=folded)]
    if folded > _NONE:
        parts.append(spark.read.parquet(f"{folder}/sums/through={folded}"))
    parts = [part.select("anr", "menge") for part in parts if part is not None]
    if not parts:
        return None
    changes = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return changes.groupBy("anr").agg(F.sum("menge").alias("menge"))


def current_stock(spark: SparkSession, parts: DataFrame, folder: str) -> DataFrame:
    """The part table with all complete batches applied; as it is before the first."""
    change = _summed(spark, folder)
    return parts.withColumn("amenge", F.col("amenge").cast("long")) if change is None else apply_delta(parts, change)


def rejects(spark: SparkSession, folder: str) -> DataFrame | None:
    """Rows of the complete batches that could not be booked, with ``grund``; None before the first batch."""
    return _complete(spark, folder, "rejected")


def refused(spark: SparkSession, folder: str) -> DataFrame | None:
    """Rows of the complete batches that the feed's check has refused; None before the first batch."""
    return _complete(spark, folder, "failed")


def compact(spark: SparkSession, folder: str) -> None:
    """Fold the complete batches into one sum per part, so that readers open few files.

    What the compaction before this one had folded is removed now: a reader that began before this one still finds it.
    """
    last, folded = _last(spark, folder, "deltas"), _last(spark, folder, "sums")
    if last <= folded:
        return
    _summed(spark, folder).write.mode("overwrite").parquet(f"{folder}/sums/through={last}")
    _publish(spark, folder, "sums", last)
    for batch in _numbers(spark, f"{folder}/deltas"):
        if batch <= folded:
            remove(spark, f"{folder}/deltas/batch={batch}")
    for through in _numbers(spark, f"{folder}/sums"):
        if through < folded:
            remove(spark, f"{folder}/sums/through={through}")
