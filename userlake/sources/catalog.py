"""Declared tables: documents that describe them, creation, conformance, registration."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from userlake.context import RunContext
from userlake.sources.records import RAW_COLUMNS, RAW_SCHEMA

Document = Mapping[str, Any]


def load_document(text: str) -> Document:
    """A JSON document {"tables": {name: {"columns": [{"name", "type", "comment"}], "partitions": [...]}}}."""
    return json.loads(text)


def describe_tables(tables: Mapping[str, DataFrame], partitions: Mapping[str, Sequence[str]]) -> Document:
    """The document of existing DataFrames, for `create_tables` elsewhere."""
    return {
        "tables": {
            name: {
                "columns": [
                    {"name": field.name, "type": field.dataType.simpleString(), "comment": ""}
                    for field in df.schema
                ],
                "partitions": list(partitions.get(name, [])),
            }
            for name, df in tables.items()
        }
    }


def declared_document(spark: SparkSession, ctx: RunContext) -> Document:
    """The document of the silver tables, read off their plans over an empty input."""
    from userlake.tables import PARTITIONS, SILVER, tables_from_raw

    tables = tables_from_raw(spark.createDataFrame([], RAW_SCHEMA), ctx)
    return describe_tables({name: tables[name] for name in SILVER}, PARTITIONS)


def declared_schema(table: Mapping[str, Any]) -> StructType:
    """Declared columns in order, with the partition columns last as on disk."""
    partitions = table.get("partitions", [])
    ordered = sorted(table["columns"], key=lambda c: c["name"] in partitions)
    return StructType(
        [
            StructField(c["name"], StructType.fromDDL(f"c {c['type']}")[0].dataType, True, {"comment": c.get("comment", "")})
            for c in ordered
        ]
    )


def create_tables(spark: SparkSession, document: Document, database: str, root: str) -> list[str]:
    """Create each declared table that is missing; existing tables gain missing columns."""
    for name, table in document["tables"].items():
        full_name = f"{database}.{name}"
        schema = declared_schema(table)
        if spark.catalog.tableExists(full_name):
            present = set(spark.table(full_name).columns)
            added = [f for f in schema if f.name not in present]
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {full_name} ADD COLUMNS ({columns})")
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        partitions = table.get("partitions", [])
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE {full_name} ({columns}) USING parquet {by} LOCATION '{root}/{name}'")
    return list(document["tables"])


def schema_differences(actual: StructType, declared: StructType) -> list[tuple[str, str, str]]:
    """(column, declared type, actual type) of each disagreement; an absent column has type ''."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in declared}
    names = [*want, *[n for n in have if n not in want]]
    return [(n, want.get(n, ""), have.get(n, "")) for n in names if want.get(n) != have.get(n)]


def conform_to_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """Declared columns in declared order and type; what cannot be cast, or is absent, becomes null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in declared
        ]
    )


def _columns_frame(spark: SparkSession, columns: list[tuple[str, str, str, bool]], kind: str) -> DataFrame:
    schema = f"table_name string, column_name string, {kind}_type string, {kind}_partition boolean"
    return spark.createDataFrame(columns, schema)


def declared_columns(spark: SparkSession, document: Document) -> DataFrame:
    """Columns of a document as rows."""
    columns = [
        (name, c["name"], StructType.fromDDL(f"c {c['type']}")[0].dataType.simpleString(), c["name"] in table.get("partitions", []))
        for name, table in document["tables"].items()
        for c in table["columns"]
    ]
    return _columns_frame(spark, columns, "declared")


def stored_columns(spark: SparkSession, database: str, names: Iterable[str]) -> DataFrame:
    """Columns of stored tables as rows, from the catalog."""
    columns = [
        (name, c.name, StructType.fromDDL(f"c {c.dataType}")[0].dataType.simpleString(), c.isPartition)
        for name in names
        if spark.catalog.tableExists(f"{database}.{name}")
        for c in spark.catalog.listColumns(f"{database}.{name}")
    ]
    return _columns_frame(spark, columns, "stored")


def conformance_rows(spark: SparkSession, document: Document, database: str) -> DataFrame:
    """Each difference between a document and the stored tables, and what the stored values make of it.

    A row has table and column, both types, the difference ('missing',
    'undeclared', 'type', 'partition'), and for a type the number of `filled`
    values and of those that are `unfit`, that is lost by a cast to the declared
    type. A table is read once, its differing columns only.
    """
    declared = declared_columns(spark, document)
    stored = stored_columns(spark, database, document["tables"])
    difference = (
        F.when(F.col("stored_type").isNull(), "missing")
        .when(F.col("declared_type").isNull(), "undeclared")
        .when(F.col("declared_type") != F.col("stored_type"), "type")
        .when(F.col("declared_partition") != F.col("stored_partition"), "partition")
    )
    compared = declared.join(stored, ["table_name", "column_name"], "full")
    differing = compared.withColumn("difference", difference).where(F.col("difference").isNotNull())
    retyped: dict[str, list[tuple[str, str]]] = {}
    for row in differing.where(F.col("difference") == "type").collect():  # columns of declared tables
        retyped.setdefault(row["table_name"], []).append((row["column_name"], row["declared_type"]))
    counts = spark.createDataFrame([], "table_name string, column_name string, filled bigint, unfit bigint")
    for name, columns in sorted(retyped.items()):
        figures = []
        for column, kind in columns:
            value = F.col(f"`{column}`")
            lost = F.count_if(value.isNotNull() & value.try_cast(kind).isNull())
            figures.append(F.struct(F.lit(column).alias("column_name"), F.count(value).alias("filled"), lost.alias("unfit")))
        counted = spark.table(f"{database}.{name}").agg(F.array(*figures).alias("figures"))
        counts = counts.unionByName(counted.select(F.lit(name).alias("table_name"), F.inline("figures")))
    return differing.join(counts, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "declared_type", "stored_type", "difference", "filled", "unfit"
    )


# Types that hold every value of the type before.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp"},
}


def widens(stored: str, declared: str) -> bool:
    """Whether every value of one type has a place in the other; text takes any."""
    return declared == "string" or declared in _WIDER.get(stored, set())


@dataclass(frozen=True)
class TypeChange:
    table: str
    column: str
    stored: str
    declared: str
    widened: bool


def evolve_tables(spark: SparkSession, document: Document, database: str, root: str) -> list[TypeChange]:
    """Bring the column types of stored tables to those declared.

    Wider types are taken: the table is written anew under `root` in the
    declared types, order and partitions, and then takes the other's place. A
    type that could lose values is reported and the column stays as it is.
    """
    changes: list[TypeChange] = []
    for name, table in document["tables"].items():
        full_name = f"{database}.{name}"
        _finish_swap(spark, full_name)
        if not spark.catalog.tableExists(full_name):
            continue
        have = {f.name: f.dataType for f in spark.table(full_name).schema}
        declared = declared_schema(table)
        found = [
            TypeChange(full_name, f.name, have[f.name].simpleString(), f.dataType.simpleString(),
                       widens(have[f.name].simpleString(), f.dataType.simpleString()))
            for f in declared
            if f.name in have and have[f.name] != f.dataType
        ]
        changes += found
        if any(change.widened for change in found):
            refused = {c.column for c in found if not c.widened}
            undeclared = [StructField(n, t) for n, t in have.items() if n not in declared.fieldNames()]
            kept = [StructField(f.name, have[f.name] if f.name in refused else f.dataType) for f in declared]
            partitions = table.get("partitions", [])
            target = StructType(
                [f for f in kept if f.name not in partitions] + undeclared + [f for f in kept if f.name in partitions]
            )
            _rewrite(spark, full_name, target, partitions, f"{root}/{name}-{uuid.uuid4().hex}")
    return changes


def _rewrite(spark: SparkSession, full_name: str, target: StructType, partitions: Sequence[str], path: str) -> None:
    """Write a table in another schema to a new folder, then let it take the name."""
    staged = f"{full_name}__staged"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in target)
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {staged} ({columns}) USING parquet {by} LOCATION '{path}'")
    conform_to_schema(spark.table(full_name), target).write.insertInto(staged, overwrite=True)
    spark.sql(f"ALTER TABLE {full_name} RENAME TO {full_name}__replaced")
    _finish_swap(spark, full_name)


def _finish_swap(spark: SparkSession, full_name: str) -> None:
    """Complete a swap, also one that a lost driver has left half done: only a whole copy gives the old table its other name."""
    replaced, staged = f"{full_name}__replaced", f"{full_name}__staged"
    if spark.catalog.tableExists(replaced):
        if not spark.catalog.tableExists(full_name):
            spark.sql(f"ALTER TABLE {staged} RENAME TO {full_name}")
        spark.sql(f"DROP TABLE {replaced}")


def register_views(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    """Make tables readable by SQL under their names."""
    for name in names:
        tables[name].createOrReplaceTempView(name)


def register_stored(spark: SparkSession, names: Iterable[str], root: str) -> None:
    """Views over Parquet folders root/name, for a session without the catalog."""
    for name in names:
        spark.read.parquet(f"{root}/{name}").createOrReplaceTempView(name)


# Columns and types of the external tables over raw users and ingest summaries.
EXTERNAL_TABLES: dict[str, str] = {
    "ext_raw_users": ", ".join(f"{name} string" for name in RAW_COLUMNS),
    "ext_user_analytics": "metric_type string, metric_name string, metric_value bigint, "
    "percentage double, created_at string",
    "ext_user_demographics": "demographic_type string, demographic_value string, user_count bigint, "
    "percentage double, created_at string",
}


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Typed view of a Parquet folder, also registered for SQL; values that do not fit become null."""
    declared = StructType.fromDDL(EXTERNAL_TABLES[name])
    typed = conform_to_schema(spark.read.parquet(path), declared)
    typed.createOrReplaceTempView(name)
    return typed
