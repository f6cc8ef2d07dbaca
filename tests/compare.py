"""Run registered queries beside their SQL and report what differs."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 10**8 else str(v)
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return f"{v.isoformat()}T00:00:00"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(value(row[i])) for i in order) for row in rows)


def oracle(folder):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        files = path / "*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return connection


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
         "boolean": "BOOLEAN"}


def compare(spark, connection, build, sql, folder):
    """None if both give the same, else a short text."""
    df = build(spark, folder)
    found = rows_of(df.columns, df.collect())
    if sql is None:
        return None
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    types = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    for field in df.schema:
        if TYPES.get(field.dataType.simpleString()) != types[field.name]:
            return f"{field.name} is {field.dataType.simpleString()}, not {types[field.name]}"
    if found != expected:
        extra = [r for r in found if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(found)][:2]
        return f"{len(found)} rows, {len(expected)} expected; only here {extra}; only there {missing}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from depotflow.session import build_session

    folder = sys.argv[1]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(folder)
    sqls = entry.oracle_sql()
    wrong = 0
    for name, build in entry.queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        begin = time.time()
        try:
            problem = compare(spark, connection, build, sqls.get(name), folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - begin
        if problem or took > 5:
            print(f"{name} {took:.1f}s {problem}", flush=True)
        wrong += bool(problem)
    print(len(entry.queries()), "queries,", wrong, "wrong")
