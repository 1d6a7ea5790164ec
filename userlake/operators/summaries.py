"""Summaries taken of raw users at ingest, each from one pass over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.context import RunContext
from userlake.functions.measures import share
from userlake.operators.tallies import TOTAL, Kind, tallies

METRIC_COLUMNS = ["metric_type", "metric_name", "metric_value", "percentage", "created_at"]
DEMOGRAPHIC_COLUMNS = ["demographic_type", "demographic_value", "user_count", "percentage", "created_at"]

GENDERS = "gender_distribution"
DOMAINS = "email_domain_distribution"
USERNAMES = "unique_usernames"


def _kind(name: str) -> Kind:
    domain = F.get(F.split("email", "@"), F.lit(1))
    return {
        GENDERS: Kind(GENDERS, F.col("gender")),
        DOMAINS: Kind(DOMAINS, domain, leading=True),
        USERNAMES: Kind(USERNAMES, F.col("username"), distinct=True),
    }[name]


def _metrics(raw: DataFrame, ctx: RunContext, *names: str) -> DataFrame:
    """Metric rows of the given kinds; the general ones are the total and the distinct usernames."""
    kind = F.col("kind")
    general = kind.isin(TOTAL, USERNAMES)
    value = F.when(kind == USERNAMES, F.col("values")).otherwise(F.col("n"))
    counted = tallies(raw, [_kind(name) for name in names])
    return counted.where(~general | F.lit(USERNAMES in names)).select(
        F.when(general, F.lit("general")).otherwise(kind).alias("metric_type"),
        F.when(kind == TOTAL, F.lit("total_users"))
        .when(kind == USERNAMES, F.lit(USERNAMES))
        .when(kind == GENDERS, F.concat(F.lit("gender_"), "value"))
        .otherwise(F.concat(F.lit("domain_"), "value"))
        .alias("metric_name"),
        value.alias("metric_value"),
        F.when(kind == TOTAL, F.lit(100.0)).otherwise(share(value, F.col("total"))).alias("percentage"),
        F.lit(ctx.iso_text()).alias("created_at"),
    )


def gender_distribution(raw: DataFrame, ctx: RunContext) -> DataFrame:
    return _metrics(raw, ctx, GENDERS)


def email_domain_top10(raw: DataFrame, ctx: RunContext) -> DataFrame:
    return _metrics(raw, ctx, DOMAINS).orderBy(F.desc("metric_value"), "metric_name")


def general_metrics(raw: DataFrame, ctx: RunContext) -> DataFrame:
    """User and distinct username counts."""
    return _metrics(raw, ctx, USERNAMES)


def user_analytics(raw: DataFrame, ctx: RunContext) -> DataFrame:
    return _metrics(raw, ctx, GENDERS, DOMAINS, USERNAMES)


def users_with_location(raw: DataFrame) -> DataFrame:
    """Country and state as the fourth and third parts of the address; null where absent."""
    parts = F.split("address", ",")
    return raw.withColumns(
        {"country": F.trim(F.get(parts, F.lit(3))), "state": F.trim(F.get(parts, F.lit(2)))}
    )


def _locations(raw: DataFrame, ctx: RunContext, levels: Sequence[str]) -> DataFrame:
    """Counts of non-empty locations; shares are of all users, also of those without the location."""
    kinds = [
        Kind(f"{level}_distribution", F.col(level), where=F.col(level) != "", leading=level == "state") for level in levels
    ]
    return tallies(users_with_location(raw), kinds).where(F.col("kind") != TOTAL).select(
        F.col("kind").alias("demographic_type"),
        F.col("value").alias("demographic_value"),
        F.col("n").alias("user_count"),
        share(F.col("n"), F.col("total")).alias("percentage"),
        F.lit(ctx.iso_text()).alias("created_at"),
    )


def country_distribution(raw: DataFrame, ctx: RunContext) -> DataFrame:
    return _locations(raw, ctx, ["country"]).orderBy(F.desc("user_count"), "demographic_value")


def state_distribution_top10(raw: DataFrame, ctx: RunContext) -> DataFrame:
    return _locations(raw, ctx, ["state"]).orderBy(F.desc("user_count"), "demographic_value")


def user_demographics(raw: DataFrame, ctx: RunContext) -> DataFrame:
    return _locations(raw, ctx, ["country", "state"])
