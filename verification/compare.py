"""Run registered queries beside their SQL and compare names, types, rows and values.

    python -m verification.compare FOLDER [NAME ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracle import statements
from verification.queries import registered

DUCK_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "DATE": "date",
    "BOOLEAN": "boolean",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def spark_side(df: DataFrame) -> tuple[dict[str, str], Counter]:
    names = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return types, Counter(tuple(row[n] for n in names) for row in df.collect())


def duck_side(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], Counter]:
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: DUCK_TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return types, Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree, otherwise the first disagreement."""
    have_types, have = spark_side(df)
    want_types, want = duck_side(connection, sql)
    if have_types != want_types:
        return f"types {sorted(set(have_types.items()) ^ set(want_types.items()))}"
    if have != want:
        extra, absent = have - want, want - have
        return (
            f"rows {have.total()} and {want.total()}, {extra.total()} differ:"
            f" {list(extra)[:2]} against {list(absent)[:2]}"
        )
    return ""


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(folder), statements(), []
    for name, query in registered().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            df = query(spark, folder)
            problem = difference(df, connection, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.perf_counter() - start:.2f}s {problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
