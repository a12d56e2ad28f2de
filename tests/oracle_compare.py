"""Run registered queries in Spark and DuckDB and compare all rows.

As a script: ``python tests/oracle_compare.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in sorted(glob.glob(os.path.join(sf_dir, "*.parquet"))):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 9))
        return repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}


def difference(spark, connection, name: str, query, sql: str | None, sf_dir: str) -> str | None:
    df = query(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return None
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    for column, kind in df.dtypes:
        if KINDS.get(kind, kind) != types[column]:
            return f"type of {column}: {kind} / {types[column]}"
    ours, theirs = canonical(df.columns, got), canonical(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} / {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(df.columns)}\n  spark  {a}\n  duckdb {b}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    database = connect(sf_dir)
    sqls, failed = entry.oracle_sql(), 0
    for key, run in entry.queries().items():
        if sys.argv[2:] and key not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = difference(session, database, key, run, sqls.get(key), sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{key:28s} {time.time() - started:6.2f}s  {'ok' if problem is None else problem}", flush=True)
    print("failed:", failed)
