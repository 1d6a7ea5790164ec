"""Writers for folders and catalog tables."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_PARTITION_MODE = "spark.sql.sources.partitionOverwriteMode"

# Error conditions of a session without the table format, or without the table's database.
_UNAVAILABLE = {
    "DATA_SOURCE_NOT_FOUND", "FORBIDDEN_DATASOURCE_IN_SPARK_CONNECT", "SCHEMA_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND",
    "CATALOG_NOT_FOUND", "UNSUPPORTED_DATASOURCE_FOR_DIRECT_QUERY",
}

_log = logging.getLogger(__name__)


def _unavailable(error: Exception) -> bool:
    """Whether the format or the place is missing; a fault of the rows themselves is not such a case."""
    if isinstance(error, AnalysisException):
        return (error.getCondition() or "").split(".")[0] in _UNAVAILABLE
    return isinstance(error, Py4JJavaError) and "ClassNotFoundException" in str(error)

# Named file formats.
FILE_FORMATS = {"parquet_snappy": "snappy", "parquet_plain": "none"}

# CSV options under which text comes back as it was, spaces and nulls included.
CSV_OPTIONS = {
    "header": True, "nullValue": "\\N", "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_folder(df: DataFrame, path: str, file_format: str = "parquet_snappy") -> str:
    """Replace a Parquet folder."""
    df.write.mode("overwrite").option("compression", FILE_FORMATS[file_format]).parquet(path)
    return path


def write_json_and_csv(df: DataFrame, json_path: str, csv_path: str) -> None:
    """Dump records as JSON lines and as CSV with a header; absent values stay apart from empty ones."""
    df.write.mode("overwrite").json(json_path)
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(csv_path)


@contextmanager
def _replacing_only_written_partitions(spark: SparkSession) -> Iterator[None]:
    """Inserts take this mode from the session alone, so a session writes one table at a time."""
    before = spark.conf.get(_PARTITION_MODE)
    spark.conf.set(_PARTITION_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_PARTITION_MODE, before)


def save_table(
    df: DataFrame,
    table: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Write a catalog table, made on first use.

    `overwrite` replaces the partitions that `df` has rows for and keeps the
    others, so a rerun of a batch replaces that batch. `append` adds rows.
    `merge` replaces the whole table, which is how dimensions are kept. Rows
    are not moved to gather a partition: one batch may be all of them.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.write.format("parquet").option("compression", "snappy")
        if path is not None:
            writer = writer.option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.mode("overwrite").saveAsTable(table)
        return
    columns = spark.table(table).columns
    writer = df.select(*columns).write
    if mode == "append":
        writer.insertInto(table)
    elif mode == "overwrite":
        with _replacing_only_written_partitions(spark):
            writer.insertInto(table, overwrite=True)
    elif mode == "merge":
        writer.insertInto(table, overwrite=True)
    else:
        raise ValueError(f"unknown write mode: {mode}")


def save_table_or_folder(
    df: DataFrame,
    table: str,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    provider: str = "parquet",
) -> str:
    """Write a table; without its format create it plainly and insert; without its database write a folder.

    `provider` is the table format to try first. Rows that do not fit the table
    are an error and are written nowhere. Returns which of "table",
    "insert" and "folder" took the rows.
    """
    spark = df.sparkSession
    try:
        if provider != "parquet":
            writer = df.write.format(provider).option("path", path)
            writer.mode("append" if mode == "append" else "overwrite").saveAsTable(table)
        else:
            save_table(df, table, mode, partition_by, path)
        return "table"
    except (AnalysisException, Py4JJavaError) as error:
        if not _unavailable(error):
            raise
        _log.warning("%s: format %s is not available, inserting instead", table, provider)
    try:
        if not spark.catalog.tableExists(table):
            save_table(df.limit(0), table, "overwrite", partition_by, f"{path}_table")
        save_table(df, table, mode, partition_by)
        return "insert"
    except (AnalysisException, Py4JJavaError) as error:
        if not _unavailable(error):
            raise
        _log.warning("%s is not available, rows go to %s_parquet", table, path)
        df.write.mode("append" if mode == "append" else "overwrite").parquet(f"{path}_parquet")
        return "folder"


def empty_partition(spark: SparkSession, table: str, column: str, value: date) -> None:
    """Leave a dated partition of a table without rows."""
    schema = StructType([f for f in spark.table(table).schema if f.name != column])
    view = f"nothing_for_{table.replace('.', '_')}"
    spark.createDataFrame([], schema).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = DATE'{value}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
