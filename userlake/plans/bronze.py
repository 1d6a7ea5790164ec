"""Checks on the raw users and on the ingest summaries."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.functions.enrichment import age_group, source_date
from userlake.functions.measures import down, rows, share, up
from userlake.operators.tallies import TOTAL, Kind, tallies
from userlake.plans.naming import collector

if TYPE_CHECKING:
    from userlake.tables import Tables

CHECKS: dict = {}
check = collector(CHECKS)


@check
def latest_users_10(t: Tables) -> DataFrame:
    return t["raw_users"].orderBy(down("registered_date"), up("id"), up("picture")).limit(10)


@check
def total_users(t: Tables) -> DataFrame:
    return t["raw_users"].agg(rows().alias("total_users"))


@check
def gender_from_analytics(t: Tables) -> DataFrame:
    return (
        t["user_analytics"]
        .filter("metric_type = 'gender_distribution'")
        .select("metric_name", F.col("metric_value").alias("count"), "percentage")
        .orderBy(down("count"))
    )


def _counts_and_shares(t: Tables, kind: Kind) -> DataFrame:
    """The values of one kind among raw users, their counts and their shares of all users."""
    counted = tallies(t["raw_users"], [kind]).where(F.col("kind") != TOTAL)
    return counted.select(
        F.col("value").alias(kind.name), F.col("n").alias("count"), share(F.col("n"), F.col("total")).alias("percentage")
    )


@check
def gender_from_raw(t: Tables) -> DataFrame:
    return _counts_and_shares(t, Kind("gender", F.col("gender"))).orderBy(down("count"))


def _top_locations(t: Tables, level: str, limit: int) -> DataFrame:
    return (
        t["user_demographics"]
        .filter(F.col("demographic_type") == f"{level}_distribution")
        .select(F.col("demographic_value").alias(level), "user_count", "percentage")
        .orderBy(down("user_count"), level)
        .limit(limit)
    )


@check
def top_countries_10(t: Tables) -> DataFrame:
    return _top_locations(t, "country", 10)


@check
def top_states_10(t: Tables) -> DataFrame:
    return _top_locations(t, "state", 10)


@check
def domains_from_analytics(t: Tables) -> DataFrame:
    return (
        t["user_analytics"]
        .filter("metric_type = 'email_domain_distribution'")
        .select(
            F.replace("metric_name", F.lit("domain_"), F.lit("")).alias("email_domain"),
            F.col("metric_value").alias("count"),
            "percentage",
        )
        .orderBy(down("count"))
    )


@check
def domains_from_raw_10(t: Tables) -> DataFrame:
    """Text after the first @; an address without one counts under the empty domain."""
    domain = Kind("email_domain", F.split_part("email", F.lit("@"), F.lit(2)))
    return _counts_and_shares(t, domain).orderBy(down("count"), up("email_domain")).limit(10)


@check
def registrations_by_year(t: Tables) -> DataFrame:
    year = F.year(source_date(F.col("registered_date")))
    return (
        t["raw_users"]
        .groupBy(year.alias("registration_year"))
        .agg(rows().alias("user_count"))
        .orderBy(up("registration_year"))
    )


@check
def age_distribution_raw(t: Tables) -> DataFrame:
    """Age as the difference of calendar years, unlike the cleaned table's age."""
    age = F.year(t.ctx.today()) - F.year(source_date(F.col("dob")))
    return (
        t["raw_users"]
        .groupBy(age_group(age).alias("age_group"))
        .agg(rows().alias("count"))
        .orderBy("age_group")
    )


@check
def gender_by_top5_country(t: Tables) -> DataFrame:
    """Genders in the five largest countries, the country read as the last word of the address."""
    last_part = F.split_part("address", F.lit(","), F.lit(-1))
    named = t["raw_users"].withColumn("country", F.split_part(last_part, F.lit(" "), F.lit(-1)))
    largest = _top_locations(t, "country", 5).select("country")
    return (
        named.join(largest, "country", "left_semi")
        .groupBy("country", "gender")
        .agg(rows().alias("count"))
        .orderBy("country", down("count"))
    )


@check
def bronze_data_checks(t: Tables) -> DataFrame:
    """Four counts of doubtful records from one scan."""
    email = F.col("email")
    doubts = {
        "Missing IDs": F.col("id").isNull() | (F.col("id") == ""),
        "Missing emails": email.isNull() | (email == ""),
        "Invalid email format": ~email.like("%@%.%"),
        "Future birth dates": source_date(F.col("dob")) > t.ctx.today(),
    }
    counts = [F.count_if(condition).alias(f"n{i}") for i, condition in enumerate(doubts.values())]
    cells = [c for i, label in enumerate(doubts) for c in (F.lit(label), F.col(f"n{i}"))]
    return t["raw_users"].agg(*counts).select(
        F.stack(F.lit(len(doubts)), *cells).alias("check_type", "count")
    )


@check
def processing_recency(t: Tables) -> DataFrame:
    def recency(name: str, label: str) -> DataFrame:
        return t[name].agg(
            F.lit(label).alias("data_type"),
            F.max("created_at").alias("latest_processing_time"),
            F.countDistinct("created_at").alias("processing_batches"),
        )

    return recency("user_analytics", "Analytics").unionByName(recency("user_demographics", "Demographics"))


@check
def processing_volume(t: Tables) -> DataFrame:
    return (
        t["user_analytics"]
        .groupBy(F.to_date("created_at").alias("processing_date"))
        .agg(rows().alias("records_processed"))
        .orderBy(down("processing_date"))
    )
