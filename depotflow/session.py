"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "depotflow", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the library is tuned for; keyword settings override them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Repeated values take far less room in files than in memory; without this a large table
        # whose columns compress well could be taken for one that is small enough to broadcast.
        "spark.sql.sources.fileCompressionFactor": "10",
        # Split hot join partitions even where that costs one more shuffle above the join.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not configured:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="depotflow-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


# Folders handed out and not yet removed, in order.
_folders: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the folder that ``spark.checkpoint.dir`` names."""
    base = _ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/depotflow/{purpose}-{uuid.uuid4().hex}"
    _folders.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a written folder, wherever Spark's file systems keep it; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is written to the shared folder inside the ``with`` block at its end.

    Results that are still to be read afterwards must have been written elsewhere by then.
    """
    before = len(_folders)
    try:
        yield
    finally:
        own = _folders[before:]
        del _folders[before:]
        for path in own:
            remove(spark, path)


def frozen(df: DataFrame, path: str | None = None) -> DataFrame:
    """Compute ``df`` once into a table of the shared folder and go on from there.

    Later jobs all see the same rows, read only the columns they need, and lose nothing with an
    executor. The files have true sizes, so joins with the table follow Spark's own broadcast limit.
    ``path`` is a folder from ``shared_folder``, if one made before a ``scratch`` block is to outlast it.
    """
    path = path or shared_folder(df.sparkSession, "frozen")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
