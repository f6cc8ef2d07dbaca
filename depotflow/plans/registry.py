"""Named queries, each with the SQL its result is compared with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from depotflow.sources.star import Star, from_tables

# The model on the stored tables, for the comparison queries.
MODEL = {
    "lieferant": """lieferant AS (
        SELECT s_suppkey AS lnr, s_name AS lname, n_name AS lstadt,
               CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal / 100) AS INTEGER) END AS status
        FROM supplier JOIN nation ON n_nationkey = s_nationkey)""",
    "artikel": """artikel AS (
        SELECT p_partkey AS anr, p_name AS aname, split_part(p_name, ' ', 1) AS farbe,
               CAST(p_size AS DOUBLE) AS gewicht, n_name AS astadt,
               CAST(floor(p_retailprice) AS BIGINT) AS amenge
        FROM part JOIN nation ON n_nationkey = p_partkey % 20)""",
    "lieferung": """lieferung AS (
        SELECT l_suppkey AS lnr, l_partkey AS anr, CAST(trunc(l_quantity) AS INTEGER) AS lmenge,
               l_shipdate AS ldatum
        FROM lineitem)""",
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Star], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(star)`` under a name."""

    def add(build: Callable[[Star], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = Query(name, build, None if sql is None else with_model(sql))
        return build

    return add


def with_model(sql: str) -> str:
    """Put the model tables that ``sql`` mentions in front of it."""
    body = sql.strip()
    used = [text for name, text in MODEL.items() if name in body]
    if not used:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(used)}, {body[5:]}"
    return f"WITH {', '.join(used)} {body}"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare with any engine's."""
    decimals = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(decimals) if decimals else df


def runnable(entry: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(entry.build(from_tables(spark, folder)))

    return run
