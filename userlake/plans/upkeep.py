"""Daily upkeep of tables whose rows depend on more than one batch, without reading the history of users again."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.context import RunContext
from userlake.operators import facts, trends
from userlake.sources.scratch import stored_rows
from userlake.sources.sinks import empty_partition
from userlake.tables import DAILY_FIGURES, KNOWN_USERS, USERS

if TYPE_CHECKING:
    from userlake.plans.jobs import Lake

BATCH_DATE = "processing_date"


def of_dates(df: DataFrame, dates: Sequence[date] | None) -> DataFrame:
    return df if dates is None else df.filter(F.col(BATCH_DATE).isin(list(dates)))


def _other_dates(df: DataFrame, dates: Sequence[date]) -> DataFrame:
    return df.filter(~F.col(BATCH_DATE).isin(list(dates)))


def counted_users(users: DataFrame) -> DataFrame:
    """Each user id once, under the first batch that has it."""
    return users.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(BATCH_DATE).alias(BATCH_DATE))


def new_users(arrived: DataFrame, known: DataFrame) -> DataFrame:
    """Of the ids of the run's dates those that no other date is counted with."""
    return counted_users(arrived).join(known.select("id"), "id", "left_anti")


def users_left_behind(before: DataFrame, arrived: DataFrame, known: DataFrame) -> DataFrame:
    """Ids that were counted with the run's dates, are in them no longer and are counted nowhere else."""
    return before.select("id").join(arrived.select("id"), "id", "left_anti").join(known.select("id"), "id", "left_anti")


def keep_known_users(lake: Lake, dates: Sequence[date] | None) -> None:
    """Bring the table of counted users up to date.

    A day's ids are compared with the ids known so far; users of other dates
    are read only if a repeated date has lost users, to see which other date
    has them. Those are added before the date's own rows are replaced, so that
    a run that breaks off can be repeated.
    """
    spark, table = lake.spark, f"{lake.database}.{KNOWN_USERS}"
    users = spark.table(f"{lake.database}.{USERS}").select("id", BATCH_DATE)
    if dates is None or not spark.catalog.tableExists(table):
        lake.save(KNOWN_USERS, counted_users(users), "merge")
        return
    arrived, known = of_dates(users, dates), spark.table(table)
    elsewhere = _other_dates(known, dates)
    fresh = stored_rows(new_users(arrived, elsewhere), "new-users")
    left_behind = stored_rows(users_left_behind(of_dates(known, dates), arrived, elsewhere), "left-behind")
    if not left_behind.isEmpty():
        others = _other_dates(users, dates).join(left_behind, "id", "left_semi")
        lake.save(KNOWN_USERS, counted_users(others), "append")
    lake.save(KNOWN_USERS, fresh, "overwrite")
    filled = {row[0] for row in fresh.select(BATCH_DATE).distinct().collect()}  # dates of the run at most
    for day in sorted(set(dates) - filled):
        empty_partition(spark, table, BATCH_DATE, day)


def keep_quality_metrics(lake: Lake, name: str, ctx: RunContext, dates: Sequence[date] | None) -> None:
    """The quality row over all batches, from the figures of each batch; only the run's dates are read again."""
    users = of_dates(lake.spark.table(f"{lake.database}.{USERS}"), dates)
    lake.save(DAILY_FIGURES, facts.daily_quality_figures(users), "merge" if dates is None else "overwrite")
    keep_known_users(lake, dates)
    days, known = (lake.spark.table(f"{lake.database}.{t}") for t in (DAILY_FIGURES, KNOWN_USERS))
    lake.save(name, facts.quality_metrics_of_days(days, known, ctx), "overwrite")


def keep_quality_trends(lake: Lake, name: str, ctx: RunContext, dates: Sequence[date] | None) -> None:
    """The quality trend; a run makes the rows of its dates and the ones after them."""
    spark, table = lake.spark, f"{lake.database}.{name}"
    users = of_dates(spark.table(f"{lake.database}.{USERS}"), dates)
    if dates is None or not spark.catalog.tableExists(table):
        lake.save(name, trends.data_quality_trends(users, ctx), "merge" if dates is None else "overwrite")
        return
    changed = trends.quality_trends_of_dates(spark.table(table), trends.daily_quality(users), dates, ctx)
    lake.save(name, stored_rows(changed, "quality-trends"), "overwrite")
