"""New JSON user records -> raw table and summaries, each file and each user id once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from userlake.context import RunContext
from userlake.operators import summaries
from userlake.sources.records import parse_user_json, topic_options
from userlake.sources.sinks import write_folder

BATCH = "ingest_batch"


def stream_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines of the files that appear under a folder, as a `value` column."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Records of a topic as they arrive; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic))
    return reader.option("startingOffsets", "earliest").load()


def new_records(batch: DataFrame, earlier: DataFrame | None, key: str = "id") -> DataFrame:
    """The records of a batch whose key no earlier batch has, one for each key.

    Of records with one key the smallest by its columns stays, so that a
    repeated batch gives the same rows. Records whose key is null or empty are
    all kept; the cleaning rules mark them.
    """
    keyed = F.coalesce(F.col(key) != "", F.lit(False))
    whole = F.struct(*[F.col(c) for c in batch.columns])
    one_each = batch.where(keyed).groupBy(key).agg(F.min(whole).alias("_record")).select("_record.*")
    if earlier is not None:
        one_each = one_each.join(earlier.select(key), key, "left_anti").select(*batch.columns)
    return one_each.unionByName(batch.where(~keyed))


def ingest_available(
    messages: DataFrame,
    raw_path: str,
    checkpoint: str,
    after_batch: Callable[[DataFrame, int], object] | None = None,
) -> StreamingQuery:
    """Append what has arrived since the last run to the raw folder, then stop.

    A user id that an earlier batch brought is not added again. Each
    micro-batch owns one partition folder and overwrites it, so a batch that is
    repeated after a failure replaces its own half-written rows.
    `after_batch` gets the stored users of a batch and its number; it too may be
    called again for the same number and should then replace what it wrote.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        earlier = None
        if batch_id > 0:
            kept = StructType([*batch.schema, StructField(BATCH, IntegerType())])
            earlier = batch.sparkSession.read.schema(kept).parquet(raw_path).where(F.col(BATCH) < batch_id)
        (
            new_records(batch, earlier).withColumn(BATCH, F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(BATCH)
            .parquet(raw_path)
        )
        if after_batch is not None:
            own = batch.sparkSession.read.schema(batch.schema).parquet(f"{raw_path}/{BATCH}={batch_id}")
            after_batch(own, batch_id)

    return (
        parse_user_json(messages)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@dataclass(frozen=True)
class BatchReport:
    """What one ingest batch wrote, with a few figures for the log.

    Distributions without a fixed number of groups are DataFrames over the
    written folders; only the top five entries are values here.
    """

    processed_users: int
    raw_path: str
    analytics_path: str
    demographics_path: str
    gender_distribution: DataFrame
    country_distribution: DataFrame
    top_email_domains: dict[str, int]
    top_states: dict[str, int]
    timestamp: str


def process_user_batch(users: DataFrame, root: str, ctx: RunContext) -> BatchReport | None:
    """Write raw users and both summaries; nothing is written for an empty input."""
    if users.isEmpty():
        return None
    spark = users.sparkSession
    raw_path = write_folder(users, f"{root}/raw_users")
    raw = spark.read.parquet(raw_path)
    analytics_path = write_folder(summaries.user_analytics(raw, ctx), f"{root}/user_analytics")
    demographics_path = write_folder(summaries.user_demographics(raw, ctx), f"{root}/user_demographics")
    analytics = spark.read.parquet(analytics_path)
    demographics = spark.read.parquet(demographics_path)

    def top(rows: DataFrame, kind: str, name: str, value: str) -> dict[str, int]:
        leading = rows.filter(F.col(rows.columns[0]) == kind).orderBy(F.desc(value), name).limit(5)
        return {row[name]: row[value] for row in leading.select(name, value).collect()}

    return BatchReport(
        processed_users=raw.count(),
        raw_path=raw_path,
        analytics_path=analytics_path,
        demographics_path=demographics_path,
        gender_distribution=analytics.filter("metric_type = 'gender_distribution'"),
        country_distribution=demographics.filter("demographic_type = 'country_distribution'"),
        top_email_domains=top(analytics, "email_domain_distribution", "metric_name", "metric_value"),
        top_states=top(demographics, "state_distribution", "demographic_value", "user_count"),
        timestamp=ctx.iso_text(),
    )
