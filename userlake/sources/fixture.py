"""Raw users derived from the customer, nation and region tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One expression per column, in SQL that Spark and DuckDB read alike.
USER_EXPRESSIONS: dict[str, str] = {
    "id": "CASE WHEN c_custkey % 97 = 5 THEN '' WHEN c_custkey % 101 = 7 THEN NULL"
    " ELSE CAST(c_custkey AS STRING) END",
    "first_name": "concat('  fIRST', CAST(c_custkey % 200 AS STRING), ' ')",
    "last_name": "concat('LAST', CAST(c_custkey % 300 AS STRING))",
    "gender": "CASE WHEN c_custkey % 7 < 4 THEN 'female' ELSE 'male' END",
    "address": "concat(CAST(c_custkey % 900 + 1 AS STRING), ' ', c_mktsegment, ' Road, City',"
    " CAST(c_nationkey * 4 + c_custkey % 4 AS STRING), ', ',"
    " CASE WHEN c_custkey % 10 = 0 THEN 'Bavaria'"
    " ELSE translate(n_name, '_0123456789', ' ABCDEFGHIJ') END, ', ', r_name)",
    "post_code": "lpad(CAST(c_custkey % 99999 AS STRING), 5, '0')",
    "email": "CASE WHEN c_custkey % 13 = 0 OR c_custkey % 12 = 5"
    " THEN concat('user', CAST(c_custkey AS STRING), '_at_bad')"
    " WHEN c_custkey % 17 = 0 THEN NULL"
    " ELSE concat('user', CAST(c_custkey AS STRING), '@',"
    " CASE c_custkey % 8 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'hotmail.com'"
    " WHEN 3 THEN 'outlook.com' WHEN 4 THEN 'uni.edu' WHEN 5 THEN 'agency.gov' WHEN 6 THEN 'corp.com'"
    " ELSE 'acme.co.uk' END) END",
    "username": "concat('u', CAST(c_custkey % 1400 AS STRING))",
    "dob": "CASE WHEN c_custkey % 89 = 3 THEN NULL"
    " ELSE concat(CAST(DATE '1940-01-01' + CAST((c_custkey * 7919) % 24000 AS INT) AS STRING),"
    " 'T03:04:05.678Z') END",
    "registered_date": "concat(CASE WHEN c_custkey % 20 = 0 THEN '2020-06-15'"
    " ELSE CAST(DATE '2015-01-01' + CAST((c_custkey * 1327) % 3650 AS INT) AS STRING) END,"
    " 'T10:11:12.345Z')",
    "phone": "CASE WHEN c_custkey % 11 = 0 THEN '12345' WHEN c_custkey % 19 = 1 THEN NULL"
    " WHEN c_custkey % 2 = 0 THEN concat('(555) ', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '-',"
    " lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))"
    " ELSE concat('+44 ', lpad(CAST(c_custkey AS STRING), 9, '0')) END",
    "picture": "concat('https://example.org/p/', CAST(c_custkey AS STRING), '.jpg')",
    "processing_date": "DATE '2024-10-01' + CAST(c_custkey % 12 AS INT)",
}


# Columns read of each table. Given as schemas, so that no job is run to infer them.
TABLE_COLUMNS: dict[str, str] = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def users_of_customers(spark: SparkSession, folder: str) -> DataFrame:
    """One raw user per customer, in twelve dated batches."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLE_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")

    joined = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.selectExpr(*[f"{text} AS {name}" for name, text in USER_EXPRESSIONS.items()])
