"""Cleaned users -> demographics dimension and fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userlake.context import RunContext
from userlake.functions import scoring
from userlake.functions.measures import rows, share, tally, tally_value
from userlake.operators.ranking import falling, with_range_number, with_row_number


def with_batch_total(fact: DataFrame, name: str) -> DataFrame:
    """Add the number of users in the row's batch, the sum of `user_count` over the batch.

    The totals are joined back, so a batch's rows need not meet in one task as
    they would in a window over the batch; whether to broadcast them is left to
    their size.
    """
    totals = fact.groupBy(F.col("processing_date").alias("_batch")).agg(F.sum("user_count").alias(name))
    same_batch = F.col("processing_date").eqNullSafe(F.col("_batch"))
    return fact.join(totals, same_batch).drop("_batch")


def user_demographics(users: DataFrame, ctx: RunContext) -> DataFrame:
    people = users.select(
        F.col("id").alias("user_id"),
        "age_group", "generation", "gender", "country", "city",
        "email_provider_type", "account_tenure_category", "data_quality_score", "processing_date",
    ).distinct()
    scored = people.withColumn("demographic_score", scoring.demographic_score())
    return scored.withColumns(
        {
            "target_segment": scoring.target_segment(F.col("demographic_score")),
            "dim_created_at": ctx.timestamp(),
            "dim_updated_at": ctx.timestamp(),
            "is_current": F.lit(True),
        }
    )


def _place_stats(users: DataFrame, keys: list[str], kind: str, place: Column) -> DataFrame:
    counted = users.groupBy(*keys, "processing_date").agg(
        rows().alias("user_count"),
        F.countDistinct("email_domain").alias("unique_email_domains"),
        F.avg("age_years").alias("avg_age"),
        F.avg("data_quality_score").alias("avg_data_quality"),
        tally_value("gender", "male").alias("_male"),
        tally_value("gender", "female").alias("_female"),
        tally_value("email_provider_type", "Business").alias("_business"),
    )
    everyone = F.col("user_count")
    return counted.select(
        place.alias("geographic_level"),
        F.lit(kind).alias("analysis_type"),
        "user_count", "unique_email_domains", "avg_age", "avg_data_quality",
        share(F.col("_male"), everyone).alias("male_percentage"),
        share(F.col("_female"), everyone).alias("female_percentage"),
        share(F.col("_business"), everyone).alias("business_email_percentage"),
        "processing_date",
    )


def country_stats(users: DataFrame) -> DataFrame:
    return _place_stats(users, ["country"], "country", F.col("country"))


def city_stats(users: DataFrame) -> DataFrame:
    return _place_stats(users, ["city", "country"], "city", F.concat_ws(", ", "city", "country"))


def geographic_analysis(users: DataFrame, ctx: RunContext) -> DataFrame:
    """Country and city rows, each kind ranked by users within its batch.

    The kinds are ranked before the union, so a filter on `analysis_type`
    removes the other branch from the plan. Both are free text, so neither
    numbers a batch in one task; ties go by name among countries and by a hash
    of the name among cities.
    """
    countries = with_range_number(
        country_stats(users), "user_count_rank",
        group=["processing_date"], order=[*falling(F.col("user_count")), F.col("geographic_level")],
    )
    cities = with_row_number(
        city_stats(users), "user_count_rank",
        group=["processing_date"], order="user_count", ties=["geographic_level"],
    )
    return countries.unionByName(cities).withColumn("created_at", ctx.timestamp())


def age_generation_analysis(users: DataFrame, ctx: RunContext) -> DataFrame:
    segments = users.groupBy("age_group", "generation", "gender", "processing_date").agg(
        rows().alias("user_count"),
        F.avg("data_quality_score").alias("avg_data_quality"),
        F.avg("account_age_days").alias("avg_account_age_days"),
        F.countDistinct("country").alias("countries_represented"),
        F.countDistinct("email_domain").alias("unique_email_domains"),
        tally_value("email_provider_type", "Personal").alias("personal_email_count"),
        tally_value("email_provider_type", "Business").alias("business_email_count"),
        tally_value("account_tenure_category", "Veteran").alias("veteran_users"),
        tally_value("account_tenure_category", "New").alias("new_users"),
    )
    everyone = F.col("user_count")
    shares = with_batch_total(segments, "total_users_in_batch").withColumns(
        {
            "percentage_of_total": share(everyone, F.col("total_users_in_batch")),
            "business_email_percentage": share(F.col("business_email_count"), everyone),
            "veteran_percentage": share(F.col("veteran_users"), everyone),
        }
    )
    scored = shares.withColumn("engagement_score", scoring.engagement_score())
    return scored.withColumns(
        {
            "engagement_tier": scoring.engagement_tier(F.col("engagement_score")),
            "created_at": ctx.timestamp(),
        }
    )


def email_domain_analysis(users: DataFrame, ctx: RunContext) -> DataFrame:
    domains = users.groupBy("email_domain", "email_provider_type", "processing_date").agg(
        rows().alias("user_count"),
        F.countDistinct("country").alias("countries_using"),
        F.avg("age_years").alias("avg_user_age"),
        F.avg("data_quality_score").alias("avg_data_quality"),
        tally_value("gender", "male").alias("male_users"),
        tally_value("gender", "female").alias("female_users"),
    )
    return with_batch_total(domains, "total_users_in_batch").withColumns(
        {
            "market_share_percentage": share(F.col("user_count"), F.col("total_users_in_batch")),
            "gender_ratio_male_female": F.round(F.try_divide("male_users", "female_users"), 2),
            "analysis_level": F.lit("domain"),
            "created_at": ctx.timestamp(),
        }
    )


def email_provider_analysis(users: DataFrame, ctx: RunContext) -> DataFrame:
    return (
        users.groupBy("email_provider_type", "processing_date")
        .agg(
            rows().alias("total_users"),
            F.countDistinct("email_domain").alias("unique_domains"),
            F.avg("age_years").alias("avg_age"),
            F.avg("data_quality_score").alias("avg_data_quality"),
            F.countDistinct("country").alias("countries_represented"),
        )
        .withColumns({"analysis_level": F.lit("provider_type"), "created_at": ctx.timestamp()})
    )


# Columns of the daily quality figures that add up over days.
_ADDED = [
    "total_records", "excellent_quality", "good_quality", "fair_quality", "poor_quality", "very_poor_quality",
    "valid_emails", "valid_phones", "records_with_issues",
]


def _quality_figures() -> dict[str, Column]:
    score = F.col("data_quality_score")
    bands = {
        "excellent_quality": score >= 90,
        "good_quality": score.between(80, 89),
        "fair_quality": score.between(70, 79),
        "poor_quality": score.between(50, 69),
        "very_poor_quality": score < 50,
    }
    return {
        "total_records": rows(),
        **{band: tally(condition) for band, condition in bands.items()},
        "min_quality_score": F.min(score),
        "max_quality_score": F.max(score),
        "valid_emails": tally(F.col("email_valid")),
        "valid_phones": tally(F.col("phone_valid")),
        "records_with_issues": tally(F.size("quality_issues") > 0),
    }


def _quality_row(overall: DataFrame, ctx: RunContext) -> DataFrame:
    """The columns of the table from one row of totals."""
    everyone = F.col("total_records")
    return overall.select(
        "total_records", "excellent_quality", "good_quality", "fair_quality", "poor_quality", "very_poor_quality",
        "avg_quality_score", "min_quality_score", "max_quality_score", "valid_emails", "valid_phones", "unique_users",
        "records_with_issues",
    ).withColumns(
        {
            "processing_date": ctx.today(),
            "excellent_quality_percentage": share(F.col("excellent_quality"), everyone),
            "good_quality_percentage": share(F.col("good_quality"), everyone),
            "email_validity_percentage": share(F.col("valid_emails"), everyone),
            "phone_validity_percentage": share(F.col("valid_phones"), everyone),
            "data_completeness_score": share(F.col("valid_emails") + F.col("valid_phones"), everyone * 2),
            "created_at": ctx.timestamp(),
        }
    )


def data_quality_metrics(users: DataFrame, ctx: RunContext) -> DataFrame:
    """One row over all batches, dated `ctx.as_of`."""
    overall = users.agg(
        *[figure.alias(name) for name, figure in _quality_figures().items()],
        F.avg("data_quality_score").alias("avg_quality_score"),
        F.countDistinct("id").alias("unique_users"),
    )
    return _quality_row(overall, ctx)


def daily_quality_figures(users: DataFrame) -> DataFrame:
    """The figures of each batch from which `quality_metrics_of_days` makes the row over all batches."""
    return users.groupBy("processing_date").agg(
        *[figure.alias(name) for name, figure in _quality_figures().items()],
        F.sum("data_quality_score").alias("score_total"),
        F.count("data_quality_score").alias("scored"),
    )


def quality_metrics_of_days(days: DataFrame, known_users: DataFrame, ctx: RunContext) -> DataFrame:
    """The row of `data_quality_metrics` from daily figures and from the distinct users, one row each."""
    overall = days.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        *[F.sum(name).alias(name) for name in _ADDED[1:]],
        F.try_divide(F.sum("score_total"), F.sum("scored")).alias("avg_quality_score"),
        F.min("min_quality_score").alias("min_quality_score"),
        F.max("max_quality_score").alias("max_quality_score"),
    )
    return _quality_row(overall.withColumn("unique_users", known_users.select(rows()).scalar()), ctx)


def quality_by_segment(users: DataFrame, ctx: RunContext) -> DataFrame:
    segments = users.groupBy("age_group", "generation", "processing_date").agg(
        rows().alias("segment_total"),
        F.avg("data_quality_score").alias("avg_segment_quality"),
        tally(F.col("email_valid")).alias("valid_emails_in_segment"),
        tally(F.col("phone_valid")).alias("valid_phones_in_segment"),
    )
    everyone = F.col("segment_total")
    return segments.withColumns(
        {
            "segment_email_validity_rate": share(F.col("valid_emails_in_segment"), everyone),
            "segment_phone_validity_rate": share(F.col("valid_phones_in_segment"), everyone),
            "created_at": ctx.timestamp(),
        }
    )
