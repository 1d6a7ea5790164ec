"""Cleaned users -> registration, expansion, age and quality trends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from userlake.context import RunContext
from userlake.functions import scoring
from userlake.functions.measures import rows, share, tally, tally_value
from userlake.operators.facts import with_batch_total
from userlake.operators.ranking import falling, with_range_number

# Day names by number (1 = Sunday); a missing date counts as the last one.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

PERIOD_KINDS = ["monthly", "quarterly", "day_of_week"]


def registration_calendar(users: DataFrame) -> DataFrame:
    day = F.col("registration_date")
    number = F.dayofweek(day)
    name = F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), number - 1)
    return users.withColumns(
        {
            "registration_year": F.year(day),
            "registration_month": F.month(day),
            "registration_quarter": F.quarter(day),
            "registration_day_of_week": number,
            "registration_day_name": F.coalesce(name, F.lit(DAY_NAMES[-1])),
        }
    )


def period_trends(users: DataFrame, kinds: list[str]) -> DataFrame:
    """Registrations per period of each kind and batch.

    Every user row is paired with its periods before one aggregation, so all
    kinds come from one scan and one shuffle of partial counts. Weekday rows
    carry zeros for countries and gender shares.
    """
    year = F.col("registration_year").cast("string")
    month = F.lpad(F.col("registration_month").cast("string"), 2, "0")
    quarter = F.col("registration_quarter").cast("string")
    keys = {
        "monthly": F.concat(year, F.lit("-"), month),
        "quarterly": F.concat(year, F.lit("-Q"), quarter),
        "day_of_week": F.col("registration_day_name"),
    }
    periods = F.array(*[F.struct(F.lit(k).alias("kind"), keys[k].alias("key")) for k in kinds])
    dated = registration_calendar(users).select(
        F.explode(periods).alias("period"),
        F.col("registration_date").isNull().alias("_undated"),
        "country", "age_years", "gender", "data_quality_score", "processing_date",
    )
    filler = F.col("period_type") == "day_of_week"
    counted = dated.groupBy(
        F.col("period.key").alias("time_period"), F.col("period.kind").alias("period_type"),
        "_undated", "processing_date",
    ).agg(
        rows().alias("registrations"),
        F.countDistinct(F.when(F.col("period.kind") != "day_of_week", F.col("country"))).alias(
            "countries_represented"
        ),
        F.avg("age_years").alias("avg_age_at_registration"),
        tally_value("gender", "male").alias("_male"),
        tally_value("gender", "female").alias("_female"),
        F.avg("data_quality_score").alias("avg_data_quality"),
    )
    everyone = F.col("registrations")
    return counted.select(
        "time_period", "period_type", "registrations", "countries_represented", "avg_age_at_registration",
        F.when(filler, 0.0).otherwise(share(F.col("_male"), everyone)).alias("male_percentage"),
        F.when(filler, 0.0).otherwise(share(F.col("_female"), everyone)).alias("female_percentage"),
        "avg_data_quality", "processing_date",
    )


def monthly_trends(users: DataFrame) -> DataFrame:
    return period_trends(users, ["monthly"])


def quarterly_trends(users: DataFrame) -> DataFrame:
    return period_trends(users, ["quarterly"])


def day_of_week_trends(users: DataFrame) -> DataFrame:
    return period_trends(users, ["day_of_week"])


def registration_trends(users: DataFrame, ctx: RunContext) -> DataFrame:
    """All three period kinds with growth against the period before.

    Periods follow each other in text order (weekdays alphabetically), within
    one period kind and batch: a window holds the calendar periods of one batch.
    That is a departure where there are several batches: one sequence over all
    of them would set a period beside the same period of another batch, in no
    defined order. With one batch both are the same.
    """
    timeline = W.partitionBy("period_type", "processing_date").orderBy("time_period", "registrations")
    previous = F.col("previous_registrations")
    return (
        period_trends(users, PERIOD_KINDS)
        .withColumn("previous_registrations", F.lag("registrations").over(timeline))
        .withColumns(
            {
                "growth_rate": share(F.col("registrations") - previous, previous),
                "created_at": ctx.timestamp(),
            }
        )
    )


def geographic_expansion(users: DataFrame, ctx: RunContext) -> DataFrame:
    countries = users.groupBy("country", "processing_date").agg(
        rows().alias("user_count"),
        F.min("registration_date").alias("first_user_date"),
        F.max("registration_date").alias("latest_user_date"),
        F.countDistinct("city").alias("cities_represented"),
        F.avg("age_years").alias("avg_user_age"),
        F.avg("data_quality_score").alias("avg_data_quality"),
    )
    rated = countries.withColumn(
        "days_since_first_user", F.datediff(ctx.today(), F.col("first_user_date"))
    ).withColumn(
        "user_acquisition_rate",
        F.round(F.col("user_count") / F.greatest("days_since_first_user", F.lit(1)), 4),
    )
    shared = with_batch_total(rated, "total_users_global").withColumn(
        "market_share_percentage", share(F.col("user_count"), F.col("total_users_global"))
    )
    # Country texts are free, so a batch is numbered in ranges, not in one task.
    ranked = shared
    for rank, value in {"user_count_rank": "user_count", "expansion_rate_rank": "user_acquisition_rate"}.items():
        order = [*falling(F.col(value)), F.col("country")]
        ranked = with_range_number(ranked, rank, group=["processing_date"], order=order)
    return ranked.withColumns(
        {
            "expansion_category": scoring.expansion_category(F.col("user_count_rank")),
            "created_at": ctx.timestamp(),
        }
    )


def age_trends_daily(users: DataFrame) -> DataFrame:
    return users.groupBy("age_group", "generation", "registration_date", "processing_date").agg(
        rows().alias("user_count"),
        F.avg("data_quality_score").alias("avg_data_quality"),
        F.countDistinct("country").alias("countries_represented"),
    ).withColumn("registration_year", F.year("registration_date"))


def age_demographic_trends(users: DataFrame, ctx: RunContext) -> DataFrame:
    """Daily rows folded into years: plain average of daily averages, sum of daily distinct counts."""
    yearly = age_trends_daily(users).groupBy(
        "age_group", "generation", "registration_year", "processing_date"
    ).agg(
        F.sum("user_count").alias("total_users_in_group"),
        F.avg("avg_data_quality").alias("avg_data_quality"),
        F.sum("countries_represented").alias("total_countries"),
    )
    # Both windows see age groups x generations x years of one batch.
    of_year = W.partitionBy("registration_year", "processing_date")
    over_years = W.partitionBy("age_group", "processing_date").orderBy("registration_year", "generation")
    now, before = F.col("percentage_of_year"), F.col("previous_year_percentage")
    return (
        yearly.withColumn("total_users_in_year", F.sum("total_users_in_group").over(of_year))
        .withColumn("percentage_of_year", share(F.col("total_users_in_group"), F.col("total_users_in_year")))
        .withColumn("previous_year_percentage", F.lag("percentage_of_year").over(over_years))
        .withColumns(
            {
                "trend_direction": F.when(before.isNull(), "New")
                .when(now > before, "Growing")
                .when(now < before, "Declining")
                .otherwise("Stable"),
                "trend_magnitude": F.coalesce(F.abs(now - before), F.lit(0.0)),
                "created_at": ctx.timestamp(),
            }
        )
    )


# Columns of a batch by itself; the others of the quality trend compare it with the batch before.
DAILY_QUALITY = [
    "processing_date", "total_records", "avg_quality_score",
    "excellent_quality_count", "good_quality_count", "fair_quality_count", "poor_quality_count",
    "valid_emails", "valid_phones",
    "excellent_quality_percentage", "good_quality_percentage", "email_validity_percentage", "phone_validity_percentage",
]


def daily_quality(users: DataFrame) -> DataFrame:
    score = F.col("data_quality_score")
    bands = {
        "excellent_quality_count": score >= 90,
        "good_quality_count": score.between(80, 89),
        "fair_quality_count": score.between(70, 79),
        "poor_quality_count": score < 70,
    }
    daily = users.groupBy("processing_date").agg(
        rows().alias("total_records"),
        F.avg(score).alias("avg_quality_score"),
        *[tally(condition).alias(band) for band, condition in bands.items()],
        tally(F.col("email_valid")).alias("valid_emails"),
        tally(F.col("phone_valid")).alias("valid_phones"),
    )
    everyone = F.col("total_records")
    return daily.withColumns(
        {
            "excellent_quality_percentage": share(F.col("excellent_quality_count"), everyone),
            "good_quality_percentage": share(F.col("good_quality_count"), everyone),
            "email_validity_percentage": share(F.col("valid_emails"), everyone),
            "phone_validity_percentage": share(F.col("valid_phones"), everyone),
        }
    )


def _with_change(daily: DataFrame, ctx: RunContext) -> DataFrame:
    """Daily rows that know `previous_avg_quality`, with what follows from it."""
    now, before = F.col("avg_quality_score"), F.col("previous_avg_quality")
    return daily.select(
        *DAILY_QUALITY,
        "previous_avg_quality",
        F.when(before.isNull(), "Baseline")
        .when(now > before + 1, "Improving")
        .when(now < before - 1, "Declining")
        .otherwise("Stable")
        .alias("quality_trend"),
        F.coalesce(F.round(now - before, 2), F.lit(0.0)).alias("quality_change"),
        ctx.timestamp().alias("created_at"),
    )


def _history() -> WindowSpec:
    """One row per batch in all, so this unpartitioned window is as long as the history."""
    return W.orderBy("processing_date")


def data_quality_trends(users: DataFrame, ctx: RunContext) -> DataFrame:
    """Each batch against the one before."""
    before = F.lag("avg_quality_score").over(_history())
    return _with_change(daily_quality(users).withColumn("previous_avg_quality", before), ctx)


def quality_trends_of_dates(stored: DataFrame, fresh: DataFrame, dates: Sequence[date], ctx: RunContext) -> DataFrame:
    """The rows of the quality trend that change when `dates` are made anew.

    `fresh` are the daily rows of those dates, `stored` the rows kept so far.
    A stored row says all about its own batch, so no user of another date is
    read: changed are the rows of the dates and the row after each of them,
    also where a date has become empty.
    """
    kept = stored.where(~F.col("processing_date").isin(list(dates))).select(*DAILY_QUALITY)
    chain = kept.unionByName(fresh.select(*DAILY_QUALITY)).withColumns(
        {
            "previous_avg_quality": F.lag("avg_quality_score").over(_history()),
            "_before": F.lag("processing_date").over(_history()),
        }
    )
    made = F.array(*[F.lit(d) for d in dates])
    changed = F.exists(
        made,
        lambda d: (d <= F.col("processing_date")) & (F.col("_before").isNull() | (d >= F.col("_before"))),
    )
    return _with_change(chain.where(changed), ctx)
