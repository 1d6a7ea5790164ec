"""The three batch jobs: clean, aggregate, time series."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from userlake.context import RunContext
from userlake.operators.users import users_transformed
from userlake.plans.upkeep import BATCH_DATE, keep_quality_metrics, keep_quality_trends, of_dates
from userlake.sources.sinks import empty_partition, save_table
from userlake.tables import (
    DAILY_FIGURES, INGEST_SUMMARIES, PARTITIONS, RAW, SILVER, USERS, Tables, tables_from_store,
)

AGGREGATES = [
    "dim_user_demographics", "fact_geographic_analysis", "fact_age_generation_analysis",
    "fact_email_provider_analysis", "fact_email_domain_analysis", "fact_data_quality_metrics",
    "fact_quality_by_segment",
]
# Tables whose rows depend on their own batch only.
PER_BATCH = {
    "dim_user_demographics", "fact_geographic_analysis", "fact_age_generation_analysis", "fact_email_provider_analysis",
    "fact_email_domain_analysis", "fact_quality_by_segment", "fact_registration_trends",
    "fact_geographic_expansion", "fact_age_demographic_trends",
}
# Tables over all batches that are brought up to date from the run's dates.
UPKEEP = {"fact_data_quality_metrics": keep_quality_metrics, "fact_data_quality_trends": keep_quality_trends}
TIME_SERIES = [
    "fact_registration_trends", "fact_geographic_expansion", "fact_age_demographic_trends",
    "fact_data_quality_trends", "fact_registration_anomalies", "fact_quality_anomalies",
]


class Lake:
    """A database of stored tables under one root folder."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}'")

    def save(self, name: str, df: DataFrame, mode: str) -> None:
        save_table(df, f"{self.database}.{name}", mode, PARTITIONS.get(name, []), f"{self.root}/{name}")

    def tables(self, ctx: RunContext) -> Tables:
        return tables_from_store(self.spark, self.database, ctx)


def ingest_job(lake: Lake, raw: DataFrame, ctx: RunContext) -> None:
    """Keep the raw users of the dates that arrived beside those of earlier dates, and summarise all that are kept."""
    lake.save(RAW, raw, "overwrite")
    stored = lake.tables(ctx)
    for name, builder in INGEST_SUMMARIES.items():
        lake.save(name, builder(stored), "merge")


def clean_job(lake: Lake, ctx: RunContext, batches: Sequence[date] | None = None) -> None:
    """Clean the raw users of the run's dates; earlier ones stay in the table. The quality summary is that of the run."""
    raw = of_dates(lake.tables(ctx)[RAW], batches)
    lake.save("users_transformed", users_transformed(raw, ctx), "overwrite")
    users = of_dates(lake.tables(ctx)[USERS], batches)
    lake.save("data_quality_summary", SILVER["data_quality_summary"](Tables({USERS: lambda _: users}, ctx)), "overwrite")


def aggregate_job(lake: Lake, ctx: RunContext, batches: Sequence[date] | None = None) -> None:
    """Dimension and facts; with `batches`, facts of single batches are made for those only."""
    _fill(lake, lake.tables(ctx), AGGREGATES, batches)


def time_series_job(lake: Lake, ctx: RunContext, batches: Sequence[date] | None = None) -> None:
    """Trends, then anomalies over the whole stored history."""
    _fill(lake, lake.tables(ctx), TIME_SERIES, batches)


def run_all(
    lake: Lake, raw: DataFrame, ctx: RunContext, batches: Sequence[date] | None = None
) -> Tables:
    """Raw users to stored facts; the views, checks and reports read the result.

    `raw` is what has arrived and `batches` names its dates, so that a daily run
    reads the partitions of that day instead of the whole history. Rows of
    another date are an error; a date without rows is emptied in all tables.
    """
    if batches is not None:
        arrived = {row[0] for row in raw.select(BATCH_DATE).distinct().collect()}  # one value for each day
        if arrived - set(batches):
            raise ValueError(f"rows of other dates than the run's: {sorted(map(str, arrived - set(batches)))}")
        _empty(lake, set(batches) - arrived)
    ingest_job(lake, raw, ctx)
    clean_job(lake, ctx, batches)
    aggregate_job(lake, ctx, batches)
    time_series_job(lake, ctx, batches)
    return lake.tables(ctx)


def _empty(lake: Lake, dates: set[date]) -> None:
    """Take the rows of dates out of every stored table that is kept by date."""
    for name in [RAW, *SILVER, DAILY_FIGURES]:
        table = f"{lake.database}.{name}"
        if name not in ("data_quality_summary", "fact_data_quality_metrics") and lake.spark.catalog.tableExists(table):
            for day in sorted(dates):
                empty_partition(lake.spark, table, BATCH_DATE, day)


def _fill(
    lake: Lake, stored: Tables, names: Iterable[str], batches: Sequence[date] | None = None
) -> None:
    """Write tables from the stored ones they read, so no table is derived twice."""
    recent = stored
    if batches is not None:
        users = of_dates(stored[USERS], batches)
        recent = Tables({USERS: lambda _: users}, stored.ctx)
    for name in names:
        if name in UPKEEP:
            UPKEEP[name](lake, name, stored.ctx, batches)
        else:
            lake.save(name, SILVER[name](recent if name in PER_BATCH else stored), "overwrite")
