"""The supplier (lieferant), part (artikel) and delivery (lieferung) tables as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from depotflow.sources import schema

# The small sample data set.
SUPPLIERS = [
    ("L01", "Schmidt", 20, "Hamburg"),
    ("L02", "Jonas", 10, "Ludwigshafen"),
    ("L03", "Blank", 30, "Ludwigshafen"),
    ("L04", "Clark", 20, "Hamburg"),
    ("L05", "Adam", 30, "Aachen"),
]
PARTS = [
    ("A01", "Mutter", "rot", 12, "Hamburg", 800),
    ("A02", "Bolzen", "grün", 17, "Ludwigshafen", 1200),
    ("A03", "Schraube", "blau", 17, "Mannheim", 400),
    ("A04", "Schraube", "rot", 14, "Hamburg", 900),
    ("A05", "Nockenwelle", "blau", 12, "Ludwigshafen", 1300),
    ("A06", "Zahnrad", "rot", 19, "Hamburg", 500),
]
DELIVERIES = [
    ("L01", "A01", 300, "1990-05-18"),
    ("L01", "A02", 200, "1990-07-13"),
    ("L01", "A03", 400, "1990-01-01"),
    ("L01", "A04", 200, "1990-07-25"),
    ("L01", "A05", 100, "1990-08-01"),
    ("L01", "A06", 100, "1990-07-23"),
    ("L02", "A01", 300, "1990-08-02"),
    ("L02", "A02", 400, "1990-08-05"),
    ("L03", "A02", 200, "1990-08-06"),
    ("L04", "A02", 200, "1990-08-09"),
    ("L04", "A04", 300, "1990-08-20"),
    ("L04", "A05", 400, "1990-08-21"),
]


class Star:
    """The three tables of one data set.

    A table is given as a DataFrame, or as a function that makes it from the columns it is asked
    for; that function runs when the table is first needed.
    """

    def __init__(
        self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[..., DataFrame]], folder: str | None = None
    ):
        self.spark = spark
        self.folder = folder
        self._tables = dict(tables)
        self._made: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._made:
            given = self._tables[name]
            self._made[name] = given if isinstance(given, DataFrame) else given()
        return self._made[name]

    @property
    def lieferant(self) -> DataFrame:
        return self._table("lieferant")

    @property
    def artikel(self) -> DataFrame:
        return self._table("artikel")

    @property
    def lieferung(self) -> DataFrame:
        return self._table("lieferung")

    def only(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a table; a source that is needed for other columns alone is not read."""
        given = self._tables[name]
        return (given if isinstance(given, DataFrame) else given(*columns)).select(*columns)

    def raw(self, name: str) -> DataFrame:
        """A table of the folder this data set was read from, as it is stored."""
        return stored(self.spark, self.folder, name)

    def with_tables(self, **tables: DataFrame) -> "Star":
        return Star(self.spark, {**self._tables, **tables}, self.folder)


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table with its declared schema, so that no file is opened to find it out."""
    return spark.read.schema(schema.STORED[name]).parquet(f"{folder}/{name}.parquet")


def supplier_rows(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, schema.LIEFERANT)


def part_rows(spark: SparkSession, rows) -> DataFrame:
    typed = [(*r[:3], None if r[3] is None else Decimal(r[3]), *r[4:]) for r in rows]
    return spark.createDataFrame(typed, schema.ARTIKEL)


def delivery_rows(spark: SparkSession, rows) -> DataFrame:
    typed = [(*r[:3], datetime.fromisoformat(r[3])) for r in rows]
    return spark.createDataFrame(typed, schema.LIEFERUNG)


def sample(spark: SparkSession) -> Star:
    """The sample data set as row literals."""
    return Star(spark, {
        "lieferant": supplier_rows(spark, SUPPLIERS),
        "artikel": part_rows(spark, PARTS),
        "lieferung": delivery_rows(spark, DELIVERIES),
    })


def from_tables(spark: SparkSession, folder: str) -> Star:
    """Map the supplier, part, lineitem and nation files of ``folder`` to the model."""

    def read(name: str) -> DataFrame:
        return stored(spark, folder, name)

    def placed(rows: DataFrame, place: Column, name: str, columns: tuple[str, ...]) -> DataFrame:
        """Rows with the name of their nation, which is looked up only if it is asked for."""
        if columns and name not in columns:
            return rows.withColumn(name, F.lit(None).cast("string"))
        nation = read("nation").select("n_nationkey", F.col("n_name").alias(name))
        return rows.join(nation, place == F.col("n_nationkey"))

    def lieferant(*columns: str) -> DataFrame:
        return placed(read("supplier"), F.col("s_nationkey"), "lstadt", columns).select(
            F.col("s_suppkey").alias("lnr"),
            F.col("s_name").alias("lname"),
            F.when(F.col("s_acctbal") >= 0, F.floor(F.col("s_acctbal") / 100).cast("int")).alias("status"),
            "lstadt",
        )

    def artikel(*columns: str) -> DataFrame:
        return placed(read("part"), F.col("p_partkey") % 20, "astadt", columns).select(
            F.col("p_partkey").alias("anr"),
            F.col("p_name").alias("aname"),
            F.substring_index("p_name", " ", 1).alias("farbe"),
            F.col("p_size").cast("decimal(9,2)").alias("gewicht"),
            "astadt",
            F.floor("p_retailprice").cast("long").alias("amenge"),
        )

    def lieferung(*columns: str) -> DataFrame:
        return read("lineitem").select(
            F.col("l_suppkey").alias("lnr"),
            F.col("l_partkey").alias("anr"),
            F.col("l_quantity").cast("int").alias("lmenge"),
            F.col("l_shipdate").alias("ldatum"),
        )

    return Star(spark, {"lieferant": lieferant, "artikel": artikel, "lieferung": lieferung}, folder)


def store(star: Star, folder: str) -> None:
    """Write the model as Parquet; deliveries in date order, so that date filters skip files."""
    star.lieferant.write.parquet(f"{folder}/lieferant")
    star.artikel.write.parquet(f"{folder}/artikel")
    # The key columns after the date spread one busy day over several files.
    by_date = ["ldatum", "anr", "lnr"]
    (
        star.lieferung.repartitionByRange(*by_date)
        .sortWithinPartitions(*by_date)
        .write.parquet(f"{folder}/lieferung")
    )


def load(spark: SparkSession, folder: str) -> Star:
    """Read what ``store`` wrote."""
    read = spark.read.parquet
    return Star(spark, {name: read(f"{folder}/{name}") for name in ("lieferant", "artikel", "lieferung")}, folder)


def case_insensitive(star: Star) -> Star:
    """The same tables with text columns that ignore letter case and trailing blanks everywhere.

    Groups, joins, set operations, sorting and comparisons then all follow that rule. It is not the
    default: filters on such columns do not reach the Parquet scan, and grouping by them sorts.
    """

    def collated(df: DataFrame) -> DataFrame:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        return df.withColumns({name: F.collate(F.col(name), "UTF8_LCASE_RTRIM") for name in texts})

    return star.with_tables(
        lieferant=collated(star.lieferant), artikel=collated(star.artikel), lieferung=collated(star.lieferung)
    )


def qualified(spark: SparkSession, name: str) -> DataFrame:
    """Table by one- to four-part name; a leading server part has no meaning here and is dropped."""
    parts = name.split(".")
    return spark.table(".".join(parts[-3:]))
