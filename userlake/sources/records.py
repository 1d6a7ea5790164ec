"""Raw user records: schemas, topic and file readers, JSON parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The twelve text columns of a raw user record, in order.
RAW_COLUMNS = [
    "id", "first_name", "last_name", "gender", "address", "post_code",
    "email", "username", "dob", "registered_date", "phone", "picture",
]
RAW_SCHEMA = StructType([StructField(name, StringType(), True) for name in RAW_COLUMNS])

# The record as the user service sends it, before flattening.
NESTED_SCHEMA = (
    "name struct<first: string, last: string>, gender string, "
    "location struct<street: struct<number: int, name: string>, city: string, state: string, "
    "country: string, postcode: string>, "
    "email string, login struct<username: string>, dob struct<date: string>, "
    "registered struct<date: string>, phone string, picture struct<medium: string>"
)


def topic_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": "false"}


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All records a topic holds now; needs the Kafka connector on the class path."""
    reader = spark.read.format("kafka").options(**topic_options(servers, topic))
    return reader.option("startingOffsets", "earliest").option("endingOffsets", "latest").load()


def parse_user_json(messages: DataFrame) -> DataFrame:
    """Text or binary `value` column -> twelve columns; malformed text gives a row of nulls."""
    record = F.from_json(F.col("value").cast("string"), RAW_SCHEMA)
    return messages.select(record.alias("record")).select("record.*")


def flatten_user_record(nested: DataFrame, user_id: Column | None = None) -> DataFrame:
    """Nested service records -> raw user records with a new id.

    The default id is random; a rerun after the loss of an executor may draw it
    anew, so give a column of the data where ids must be repeatable.
    """
    street = F.concat_ws(" ", F.col("location.street.number").cast("string"), F.col("location.street.name"))
    address = F.concat_ws(
        ", ", street, F.col("location.city"), F.col("location.state"), F.col("location.country")
    )
    return nested.select(
        (F.expr("uuid()") if user_id is None else user_id.cast("string")).alias("id"),
        F.col("name.first").alias("first_name"),
        F.col("name.last").alias("last_name"),
        "gender",
        address.alias("address"),
        F.col("location.postcode").cast("string").alias("post_code"),
        "email",
        F.col("login.username").alias("username"),
        F.col("dob.date").alias("dob"),
        F.col("registered.date").alias("registered_date"),
        "phone",
        F.col("picture.medium").alias("picture"),
    )


def read_raw_users(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_table_or_path(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The catalog table where it exists, otherwise the Parquet folder."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.read.parquet(path)
