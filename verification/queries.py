"""Every operator, view, check and report as a query over the given tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, TimestampType

from userlake import RunContext, Tables, tables_from_raw
from userlake.operators import facts, summaries, trends
from userlake.operators.users import enrich, users_transformed, validate_and_cleanse
from userlake.plans.jobs import Lake, run_all
from userlake.sources import catalog, records, sinks
from userlake.sources.fixture import users_of_customers
from userlake.sources.scratch import scratch_folder, stored_rows
from userlake.streaming import ingest
from userlake.tables import INGEST_SUMMARIES, READERS, SILVER

Query = Callable[[SparkSession, str], DataFrame]

CONTEXT = RunContext(as_of=date(2025, 1, 1), run_ts=datetime(2025, 1, 1))

# Averages and deviations of doubles: their last digits depend on the order in
# which an engine adds, so both sides are compared at six decimals.
ORDER_DEPENDENT: dict[str, list[str]] = {
    "fact_age_demographic_trends": ["avg_data_quality"],
    "fact_registration_anomalies": ["z_score"],
    "fact_quality_anomalies": ["z_score"],
    "report_growing5_age_groups": ["avg_data_quality"],
    "vw_anomaly_alert_dashboard": ["z_score"],
    "read_anomaly_alerts": ["z_score"],
    "vw_geographic_diversity": ["global_avg_age", "avg_business_email_pct"],
    "vw_engagement_by_generation": ["avg_account_age", "avg_business_email_pct", "avg_veteran_pct"],
    "vw_gender_by_age_group": ["avg_quality", "avg_countries_represented"],
    "vw_data_quality_batch_distribution": ["avg_score", "avg_completeness"],
    "low_quality_alert": ["avg_score"],
    "country_x_engagement": ["engagement_business_email_pct"],
    "age_engagement_rate": ["avg_business_email_pct"],
    "pipeline_health": ["avg_monthly_registrations", "avg_growth_rate", "avg_quality_score"],
}

RAW_DATED = [*records.RAW_COLUMNS, "processing_date"]


@lru_cache(maxsize=4)
def lake(spark: SparkSession, folder: str) -> Tables:
    """The plans over a folder, put together once per session; no rows are kept."""
    return tables_from_raw(users_of_customers(spark, folder), CONTEXT)


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    return lake(spark, folder)["raw_users"]


def _named(name: str) -> Query:
    return lambda spark, folder: lake(spark, folder)[name]


QUERIES: dict[str, Query] = {name: _named(name) for name in [*SILVER, *INGEST_SUMMARIES, *READERS]}


# --- row rules -------------------------------------------------------------


def _cleansed(*columns: str) -> Query:
    return lambda spark, folder: validate_and_cleanse(raw_users(spark, folder)).selectExpr(*columns)


def _enriched(*columns: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return enrich(validate_and_cleanse(raw_users(spark, folder)), CONTEXT).select(*columns)

    return run


def _issue(name: str) -> str:
    return f"array_contains(quality_issues, '{name}') AS {name}"


QUERIES |= {
    "quality_init": _cleansed("picture", "data_quality_score", "quality_issues"),
    "rule_missing_id": _cleansed("id", "picture", _issue("missing_id")),
    "rule_invalid_email": _cleansed("picture", "email", "email_valid", _issue("invalid_email")),
    "rule_invalid_phone": _cleansed("picture", "phone", "phone_valid", _issue("invalid_phone")),
    "clean_names": _cleansed("picture", "first_name_clean", "last_name_clean", "full_name"),
    "birth_date_and_age": _enriched("picture", "dob", "birth_date", "age_years"),
    "age_group": _enriched("picture", "age_years", "age_group"),
    "generation": _enriched("picture", "age_years", "generation"),
    "email_domain": _enriched("picture", "email", "email_domain"),
    "email_provider_type": _enriched("picture", "email_domain", "email_provider_type"),
    "address_fields": _enriched(
        "picture", "address", "address_parts", "street_address", "city", "state_country"
    ),
    "country": _enriched("picture", "address", "country"),
    "phone_fields": _enriched("picture", "phone", "phone_clean", "phone_formatted"),
    "registration_and_account_age": _enriched("picture", "registration_date", "account_age_days"),
    "account_tenure_category": _enriched("picture", "account_age_days", "account_tenure_category"),
    "processing_metadata": _enriched(
        "picture", "processed_at", "processing_date", "data_source", "glue_job_name"
    ),
}


# --- parts of summaries, facts and trends ----------------------------------


def _of_raw(step: Callable[..., DataFrame], *args: object) -> Query:
    return lambda spark, folder: step(raw_users(spark, folder), *args)


def _of_users(step: Callable[..., DataFrame], *args: object) -> Query:
    return lambda spark, folder: step(lake(spark, folder)["users_transformed"], *args)


QUERIES |= {
    "gender_distribution": _of_raw(summaries.gender_distribution, CONTEXT),
    "email_domain_top10": _of_raw(summaries.email_domain_top10, CONTEXT),
    "general_metrics": _of_raw(summaries.general_metrics, CONTEXT),
    "users_with_location": _of_raw(
        lambda raw: summaries.users_with_location(raw).select("picture", "address", "country", "state")
    ),
    "country_distribution": _of_raw(summaries.country_distribution, CONTEXT),
    "state_distribution_top10": _of_raw(summaries.state_distribution_top10, CONTEXT),
    "country_stats": _of_users(facts.country_stats),
    "city_stats": _of_users(facts.city_stats),
    "engagement_tier": _of_users(
        lambda users: facts.age_generation_analysis(users, CONTEXT).select(
            "age_group", "generation", "gender", "processing_date", "engagement_score", "engagement_tier"
        )
    ),
    "registration_calendar": _of_users(
        lambda users: trends.registration_calendar(users).select(
            "picture", "registration_date", "registration_year", "registration_month",
            "registration_quarter", "registration_day_of_week", "registration_day_name",
        )
    ),
    "monthly_trends": _of_users(trends.monthly_trends),
    "quarterly_trends": _of_users(trends.quarterly_trends),
    "day_of_week_trends": _of_users(trends.day_of_week_trends),
    "age_trends_daily": _of_users(trends.age_trends_daily),
}


def detect_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """The detector on another metric and threshold than the stored tables use."""
    from userlake.operators.anomalies import detect_anomalies as detect

    cities = facts.city_stats(lake(spark, folder)["users_transformed"])
    marked = detect(cities, "user_count", 1.5)
    return marked.select(
        "geographic_level", "processing_date", "user_count", F.round("z_score", 6).alias("z_score"),
        "is_anomaly", "anomaly_type", "anomaly_severity",
    )


QUERIES["detect_anomalies"] = detect_anomalies


# --- sources and sinks: each writes the users and reads them back -----------


def _json_lines(raw: DataFrame) -> DataFrame:
    return raw.select(F.to_json(F.struct(*records.RAW_COLUMNS)).alias("value"))


def parse_user_json(spark: SparkSession, folder: str) -> DataFrame:
    return records.parse_user_json(_json_lines(raw_users(spark, folder)))


def flatten_user_record(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_users(spark, folder)
    part = [F.trim(F.get(F.split("address", ","), F.lit(i))) for i in range(4)]
    nested = raw.select(
        F.col("id").alias("user_id"),
        F.struct(F.col("first_name").alias("first"), F.col("last_name").alias("last")).alias("name"),
        "gender",
        F.struct(
            F.struct(
                F.split_part(part[0], F.lit(" "), F.lit(1)).cast("int").alias("number"),
                F.regexp_replace(part[0], r"^\d+ ", "").alias("name"),
            ).alias("street"),
            part[1].alias("city"), part[2].alias("state"), part[3].alias("country"),
            F.col("post_code").alias("postcode"),
        ).alias("location"),
        "email",
        F.struct("username").alias("login"),
        F.struct(F.col("dob").alias("date")).alias("dob"),
        F.struct(F.col("registered_date").alias("date")).alias("registered"),
        "phone",
        F.struct(F.col("picture").alias("medium")).alias("picture"),
    )
    return records.flatten_user_record(nested, user_id=F.col("user_id"))


def src_parquet_users(spark: SparkSession, folder: str) -> DataFrame:
    path = sinks.write_folder(raw_users(spark, folder), scratch_folder(spark, "raw"))
    return records.read_raw_users(spark, path)


def src_table_or_path(spark: SparkSession, folder: str) -> DataFrame:
    path = sinks.write_folder(raw_users(spark, folder), scratch_folder(spark, "raw"))
    return records.read_table_or_path(spark, "no_such_table_of_users", path).select(*RAW_DATED)


def file_format_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "plain")
    sinks.write_folder(raw_users(spark, folder), path, "parquet_plain")
    return spark.read.parquet(path).select(*RAW_DATED)


def sink_parquet_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    raw, path = raw_users(spark, folder), scratch_folder(spark, "overwrite")
    sinks.write_folder(raw.select("id"), path)
    sinks.write_folder(raw, path)
    return spark.read.parquet(path).select(*RAW_DATED)


def _external(name: str, content: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = sinks.write_folder(lake(spark, folder)[content], scratch_folder(spark, name))
        return catalog.external_table(spark, name, path)

    return run


def _table_name(path: str) -> str:
    return "users_" + path.rsplit("-", 1)[1]


def sink_table(spark: SparkSession, folder: str) -> DataFrame:
    """Create, overwrite again (a rerun replaces its batches), then read the files."""
    raw, path = raw_users(spark, folder), scratch_folder(spark, "table")
    table = _table_name(path)
    sinks.save_table(raw, table, "overwrite", ["processing_date"], path)
    sinks.save_table(raw, table, "overwrite", ["processing_date"], path)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(path).select(*RAW_DATED)


def sink_table_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A table format this session lacks, so the rows go in by the second way."""
    raw, path = raw_users(spark, folder), scratch_folder(spark, "fallback")
    table = _table_name(path)
    way = sinks.save_table_or_folder(raw, table, path, "overwrite", provider="iceberg")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    written = spark.read.parquet({"insert": f"{path}_table", "folder": f"{path}_parquet", "table": path}[way])
    return written.select(*RAW_DATED)


def daily_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by layer and batch after three runs of the jobs with four of the twelve dates each, the first dates last."""
    raw, path = raw_users(spark, folder), scratch_folder(spark, "daily")
    lake = Lake(spark, f"daily_{path[-8:]}", path)
    try:
        for first in (5, 9, 1):
            days = [date(2024, 10, day) for day in range(first, first + 4)]
            ctx = RunContext(as_of=days[-1], run_ts=datetime(2024, 10, first + 3))
            stored = run_all(lake, raw.filter(F.col("processing_date").isin(days)), ctx, days)

        def counted(layer: str, rows: DataFrame, count: Column, by: Column) -> DataFrame:
            return rows.groupBy(by.alias("batch")).agg(count.cast("bigint").alias("records")).select(
                F.lit(layer).alias("layer"), "batch", "records"
            )

        every, batch = F.count(F.lit(1)), F.col("processing_date")
        totals = stored["user_analytics"].filter("metric_name = 'total_users'")
        layers = (
            counted("raw", stored["raw_users"], every, batch)
            .unionByName(counted("users", stored["users_transformed"], every, batch))
            .unionByName(counted("quality summary", stored["data_quality_summary"], F.sum("total_records"), batch))
            .unionByName(counted("facts", stored["fact_quality_by_segment"], F.sum("segment_total"), batch))
            .unionByName(counted("dimension", stored["dim_user_demographics"], F.countDistinct("user_id"), batch))
            .unionByName(counted("quality trend", stored["fact_data_quality_trends"], F.sum("total_records"), batch))
            .unionByName(counted("quality baselines", stored["fact_data_quality_trends"].filter("quality_trend = 'Baseline'"), every, batch))
            .unionByName(counted("distinct users", stored["fact_data_quality_metrics"], F.max("unique_users"), batch))
            .unionByName(counted("analytics", totals, F.sum("metric_value"), F.lit(None).cast("date")))
        )
        out = f"{path}_layers"
        layers.write.parquet(out)
        return spark.read.parquet(out)
    finally:
        spark.sql(f"DROP DATABASE {lake.database} CASCADE")


def sink_json_csv(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_users(spark, folder).select(*records.RAW_COLUMNS)
    path = scratch_folder(spark, "dump")
    sinks.write_json_and_csv(raw, f"{path}/json", f"{path}/csv")
    reader = spark.read.schema(records.RAW_SCHEMA)
    from_json = reader.json(f"{path}/json").withColumn("file_format", F.lit("json"))
    from_csv = reader.options(**sinks.CSV_OPTIONS).csv(f"{path}/csv").withColumn("file_format", F.lit("csv"))
    return from_json.unionByName(from_csv)


def temp_views(spark: SparkSession, folder: str) -> DataFrame:
    tables = lake(spark, folder)
    catalog.register_views(tables, ["raw_users", "users_transformed"])
    return spark.sql(
        "SELECT gender, count(*) AS users, count(DISTINCT username) AS usernames FROM raw_users GROUP BY gender"
    )


def register_silver_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All silver tables registered for SQL; their row counts read back by name."""
    catalog.register_views(lake(spark, folder), SILVER)
    counts = [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in SILVER]
    return spark.sql(" UNION ALL ".join(counts))


def create_tables_from_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Declared tables created empty, the users inserted, the files read."""
    root = scratch_folder(spark, "declared")
    database = _table_name(root).replace("users", "declared")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    names = catalog.create_tables(spark, catalog.declared_document(spark, CONTEXT), database, root)
    users = lake(spark, folder)["users_transformed"]
    sinks.save_table(users, f"{database}.users_transformed", "append")
    for name in names:
        spark.sql(f"DROP TABLE {database}.{name}")
    spark.sql(f"DROP DATABASE {database}")
    return spark.read.parquet(f"{root}/users_transformed").select(*users.columns)


def conform_to_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Users turned to text in another column order, brought back to the declared schema."""
    users = lake(spark, folder)["users_transformed"]
    loose = users.select(
        *[
            (F.col(c) if c == "quality_issues" else F.col(c).cast("string")).alias(c)
            for c in reversed(users.columns)
        ]
    )
    return catalog.conform_to_schema(loose, users.schema)


# Where the declared tables say another type or layout than the jobs make.
DECLARED_TYPES: dict[tuple[str, str], str] = {
    ("users_transformed", "data_quality_score"): "double",
    ("users_transformed", "quality_issues"): "string",
    ("dim_user_demographics", "data_quality_score"): "double",
    ("dim_user_demographics", "demographic_score"): "double",
    ("fact_age_generation_analysis", "engagement_score"): "double",
    ("fact_data_quality_metrics", "min_quality_score"): "double",
    ("fact_data_quality_metrics", "max_quality_score"): "double",
}
DECLARED_PARTITIONS = {"dim_user_demographics": ["target_segment"]}


def given_document(spark: SparkSession, names: list[str]) -> catalog.Document:
    """A document of the declared tables, written as a JSON file and loaded from there."""
    described = catalog.declared_document(spark, CONTEXT)["tables"]
    tables = {
        name: {
            "columns": [
                column | {"type": DECLARED_TYPES.get((name, column["name"]), column["type"])}
                for column in described[name]["columns"]
            ],
            "partitions": DECLARED_PARTITIONS.get(name, described[name]["partitions"]),
        }
        for name in names
    }
    path = scratch_folder(spark, "document")
    text = json.dumps({"tables": tables})
    spark.createDataFrame([(text,)], "value string").write.text(path)
    return catalog.load_document(spark.read.text(path, wholetext=True).first()["value"])


def conformance_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Differences between the declared tables and those that the jobs store, with the values concerned."""
    names = sorted({name for name, _ in DECLARED_TYPES})
    tables, path = lake(spark, folder), scratch_folder(spark, "conform")
    stored = Lake(spark, f"conform_{path[-8:]}", path)
    try:
        for name in names:
            stored.save(name, tables[name], "overwrite")
        found = catalog.conformance_rows(spark, given_document(spark, names), stored.database)
        return stored_rows(found, "conformance")
    finally:
        spark.sql(f"DROP DATABASE {stored.database} CASCADE")


def evolve_declared_types(spark: SparkSession, folder: str) -> DataFrame:
    """Users stored in the types that the job makes, then brought to the declared ones."""
    tables, path = lake(spark, folder), scratch_folder(spark, "evolve")
    stored = Lake(spark, f"evolve_{path[-8:]}", path)
    try:
        stored.save("users_transformed", tables["users_transformed"], "overwrite")
        document = given_document(spark, ["users_transformed"])
        catalog.evolve_tables(spark, document, stored.database, path)
        users = spark.table(f"{stored.database}.users_transformed").select(*tables["users_transformed"].columns)
        return stored_rows(users, "evolved")
    finally:
        spark.sql(f"DROP DATABASE {stored.database} CASCADE")


def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops of files, one run after each: every record arrives once."""
    raw, root = raw_users(spark, folder), scratch_folder(spark, "ingest")
    inbox, target, checkpoint = f"{root}/inbox", f"{root}/raw", f"{root}/checkpoint"
    early = F.col("processing_date") < "2024-10-07"
    for drop in (early, ~early):
        _json_lines(raw.filter(drop)).write.mode("append").text(inbox)
        ingest.ingest_available(ingest.stream_files(spark, inbox), target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select(*records.RAW_COLUMNS)


def ingest_repeated_records(spark: SparkSession, folder: str) -> DataFrame:
    """Three drops that repeat each other's records, within a file and across files, taken in and cleaned."""
    raw, root = raw_users(spark, folder), scratch_folder(spark, "repeats")
    inbox, target, checkpoint = f"{root}/inbox", f"{root}/raw", f"{root}/checkpoint"
    early = raw.filter(F.col("processing_date") < "2024-10-05")
    for drop in (early, raw, raw.unionByName(early)):
        _json_lines(drop).write.mode("append").text(inbox)
        ingest.ingest_available(ingest.stream_files(spark, inbox), target, checkpoint).awaitTermination()
    taken = spark.read.parquet(target).select(*records.RAW_COLUMNS)
    return users_transformed(taken, CONTEXT).drop("processing_date")


def process_user_batch(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_users(spark, folder)
    done = ingest.process_user_batch(raw, scratch_folder(spark, "batch"), CONTEXT)
    return spark.read.parquet(done.analytics_path)


QUERIES |= {
    "parse_user_json": parse_user_json,
    "flatten_user_record": flatten_user_record,
    "src_parquet_users": src_parquet_users,
    "src_table_or_path": src_table_or_path,
    "file_format_parquet": file_format_parquet,
    "sink_parquet_overwrite": sink_parquet_overwrite,
    "ext_table_raw_users": _external("ext_raw_users", "raw_users"),
    "ext_table_user_analytics": _external("ext_user_analytics", "user_analytics"),
    "ext_table_user_demographics": _external("ext_user_demographics", "user_demographics"),
    "sink_table": sink_table,
    "sink_table_fallback": sink_table_fallback,
    "daily_runs": daily_runs,
    "sink_json_csv": sink_json_csv,
    "temp_views": temp_views,
    "register_silver_tables": register_silver_tables,
    "create_tables_from_schema": create_tables_from_schema,
    "conform_to_schema": conform_to_schema,
    "conformance_rows": conformance_rows,
    "evolve_declared_types": evolve_declared_types,
    "incremental_ingest": incremental_ingest,
    "ingest_repeated_records": ingest_repeated_records,
    "process_user_batch": process_user_batch,
}


# --- comparable output -----------------------------------------------------


def comparable(name: str, df: DataFrame) -> DataFrame:
    """Types that two engines print alike: dates, times, lists as text; unstable digits rounded.

    Always a new DataFrame: running it leaves nothing behind in the shared plans.
    """
    changed = {}
    for field in df.schema:
        if isinstance(field.dataType, TimestampType):
            changed[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DateType):
            changed[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, ArrayType):
            changed[field.name] = F.array_join(field.name, "|")
        elif field.name in ORDER_DEPENDENT.get(name, []):
            changed[field.name] = F.round(field.name, 6)
    return df.withColumns(changed) if changed else df.select("*")


def registered() -> dict[str, Query]:
    def wrapped(name: str, query: Query) -> Query:
        return lambda spark, folder: comparable(name, query(spark, folder))

    return {name: wrapped(name, query) for name, query in QUERIES.items()}
