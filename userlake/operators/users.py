"""Raw user records -> cleansed, enriched users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.context import RunContext
from userlake.functions import cleansing, enrichment
from userlake.functions.measures import rows, tally


def validate_and_cleanse(raw: DataFrame) -> DataFrame:
    """Judge each record by the three rules and clean its names; no row is dropped."""
    judged = raw.withColumns(
        {
            "id_missing": cleansing.id_missing(F.col("id")),
            "email_valid": cleansing.email_valid(F.col("email")),
            "phone_valid": cleansing.phone_valid(F.col("phone")),
            "first_name_clean": cleansing.clean_name(F.col("first_name")),
            "last_name_clean": cleansing.clean_name(F.col("last_name")),
        }
    )
    return judged.withColumns(
        {
            "data_quality_score": cleansing.quality_score(),
            "quality_issues": cleansing.quality_issues(),
            "full_name": F.concat_ws(" ", "first_name_clean", "last_name_clean"),
        }
    ).drop("id_missing")


def enrich(cleansed: DataFrame, ctx: RunContext) -> DataFrame:
    """Add age, e-mail, address, phone, tenure and processing attributes.

    A `processing_date` that the input already carries is kept (history of
    earlier batches); otherwise the batch is dated `ctx.as_of`.
    """
    today = ctx.today()
    parsed = cleansed.withColumns(
        {
            "birth_date": enrichment.source_date(F.col("dob")),
            "registration_date": enrichment.source_date(F.col("registered_date")),
            "email_domain": enrichment.email_domain(F.col("email")),
            "address_parts": F.split("address", ","),
            "phone_clean": enrichment.phone_digits(F.col("phone")),
        }
    )
    derived = parsed.withColumns(
        {
            "age_years": enrichment.age_years(F.col("birth_date"), today),
            "account_age_days": F.datediff(today, F.col("registration_date")),
            "email_provider_type": enrichment.email_provider_type(F.col("email_domain")),
            "street_address": enrichment.address_part(F.col("address_parts"), 0),
            "city": enrichment.address_part_or_unknown(F.col("address_parts"), 1),
            "state_country": enrichment.address_part_or_unknown(F.col("address_parts"), 2),
            "phone_formatted": enrichment.phone_formatted(F.col("phone"), F.col("phone_clean")),
        }
    )
    labelled = derived.withColumns(
        {
            "age_group": enrichment.age_group(F.col("age_years")),
            "generation": enrichment.generation(F.col("age_years")),
            "account_tenure_category": enrichment.account_tenure(F.col("account_age_days")),
            "country": enrichment.country_of_state(F.col("state_country")),
            "processed_at": ctx.timestamp(),
            "data_source": F.lit(ctx.data_source),
            "glue_job_name": F.lit(ctx.job_name),
        }
    )
    if "processing_date" in cleansed.columns:
        return labelled
    return labelled.withColumn("processing_date", today)


# The 31 columns of the cleaned table, in order; a pair renames.
USER_COLUMNS: list[str | tuple[str, str]] = [
    "id", ("first_name_clean", "first_name"), ("last_name_clean", "last_name"), "full_name", "gender",
    "email", "email_domain", "email_provider_type", "email_valid", "username",
    ("phone_formatted", "phone"), "phone_valid",
    "address", "street_address", "city", "country", "post_code",
    "birth_date", "age_years", "age_group", "generation",
    "registration_date", "account_age_days", "account_tenure_category",
    "data_quality_score", "quality_issues",
    "picture", "processed_at", "processing_date", "data_source", "glue_job_name",
]


def users_transformed(raw: DataFrame, ctx: RunContext) -> DataFrame:
    """The cleaned users table: one narrow stage over the raw scan, no shuffle."""
    enriched = enrich(validate_and_cleanse(raw), ctx)
    return enriched.select(
        *[F.col(c) if isinstance(c, str) else F.col(c[0]).alias(c[1]) for c in USER_COLUMNS]
    )


def data_quality_summary(users: DataFrame, ctx: RunContext) -> DataFrame:
    score = F.col("data_quality_score")
    return users.agg(
        rows().alias("total_records"),
        tally(score >= 80).alias("high_quality_records"),
        tally(score.between(50, 79)).alias("medium_quality_records"),
        tally(score < 50).alias("low_quality_records"),
        F.avg(score).alias("avg_quality_score"),
        tally(F.col("email_valid")).alias("valid_emails"),
        tally(F.col("phone_valid")).alias("valid_phones"),
        F.countDistinct("email_domain").alias("unique_email_domains"),
        F.countDistinct("country").alias("unique_countries"),
    ).withColumns(
        {
            "quality_check_timestamp": ctx.timestamp(),
            "processing_date": ctx.today(),
            "glue_job_name": F.lit(ctx.job_name),
        }
    )
