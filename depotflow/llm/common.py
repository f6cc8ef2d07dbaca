"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import depotflow
from depotflow.llm.words import WORD

HAS_WORD = r"[^\x20\x09-\x0D]"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers the sources of this package, once in each application.

    Spark serves the archive from the driver, so the workers need no installation and no shared path.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(depotflow.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="depotflow-")).resolve() / "depotflow.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table, for work that may need the package on the workers."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text, null as the empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("long")


def training(identity: str = "doc_id") -> Column:
    """Rows whose labels may be learned from: the checksum of the id leaves another remainder than 1 by three."""
    return F.crc32(F.coalesce(F.col(identity).cast("string"), F.lit(""))) % 3 != 1
