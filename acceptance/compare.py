"""Run registered queries in Spark and DuckDB and compare whole results.

    python -m acceptance.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from acceptance import catalog, oracle

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
KINDS = {"BIGINT": "int", "INTEGER": "int", "VARCHAR": "text", "DOUBLE": "float", "BOOLEAN": "bool",
         "bigint": "int", "int": "int", "string": "text", "double": "float", "boolean": "bool"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(value: object) -> object:
    return repr(value) if not isinstance(value, float) or not math.isnan(value) else "nan"


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs in column names, column types or rows; empty if nothing does."""
    relation = connection.sql(sql)
    expected_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    actual_types = dict(df.dtypes)
    if sorted(expected_types) != sorted(actual_types):
        return [f"columns {sorted(actual_types)} instead of {sorted(expected_types)}"]
    found = [f"type of {name}: {actual_types[name]} instead of {kind}"
             for name, kind in expected_types.items()
             if KINDS.get(actual_types[name]) != KINDS.get(kind, kind)]
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    expected = _rows(relation.columns, relation.fetchall())
    if actual != expected:
        found.append(f"{(actual - expected).total()} of {actual.total()} rows unexpected, "
                     f"{(expected - actual).total()} of {expected.total()} missing; e.g. "
                     f"{list((actual - expected))[:2]} / {list((expected - actual))[:2]}")
    return found


def main(sf_dir: str, names: list[str]) -> int:
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    connection, sql, failed = duck(sf_dir), oracle.oracle_sql(), 0
    for name, query in catalog.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = differences(query(spark, sf_dir), sql[name], connection)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{name:30s} {time.time() - start:6.2f} s  {'ok' if not found else found}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
