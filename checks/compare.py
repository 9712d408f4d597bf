"""Run registered queries and their SQL side by side: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle
from checks.queries import registered
from floorline.session import build_session

EVENTS = "events"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    connection.execute(f"CREATE VIEW {EVENTS} AS SELECT * FROM '{folder}/{EVENTS}.parquet'")
    return connection


def result_rows(names: list[str], rows: list) -> list[str]:
    """Rows as text, columns by name, in a fixed order."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in rows)


# Spark type -> the type DuckDB reports for the same column.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark: SparkSession, connection: duckdb.DuckDBPyConnection, folder: str, name: str) -> list[str]:
    """What differs between a query and its SQL; empty if nothing does."""
    found = registered()[name](spark, folder)
    expected = connection.sql(oracle()[name])
    if sorted(found.columns) != sorted(expected.columns):
        return [f"columns {sorted(found.columns)} != {sorted(expected.columns)}"]
    types = {name: str(dtype) for name, dtype in zip(expected.columns, expected.types)}
    wrong = [f"{name} {dtype} != {types[name]}" for name, dtype in found.dtypes if TYPES[dtype] != types[name]]
    if wrong:
        return wrong
    left = result_rows(found.columns, [tuple(row) for row in found.collect()])
    right = result_rows(expected.columns, expected.fetchall())
    if len(left) != len(right):
        return [f"{len(left)} rows != {len(right)}"]
    return [f"{a} != {b}" for a, b in zip(left, right) if a != b]


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registered())
    spark = build_session("checks", "local[8]", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        began = time.time()
        wrong = differences(spark, connection, folder, name)
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name} {time.time() - began:.1f}s", flush=True)
        for line in wrong[:2]:
            print("     ", line[:700], flush=True)
    print(f"{len(names) - failed}/{len(names)} match")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
