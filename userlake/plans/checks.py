"""Business, monitoring and alert queries over the views."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userlake.functions.measures import down, label_above, label_below, rows, share, steady_avg, up
from userlake.plans.naming import collector
from userlake.plans.pairing import beside_every, few_rows, row_or_null

if TYPE_CHECKING:
    from userlake.tables import Tables

CHECKS: dict = {}
check = collector(CHECKS)

# Score ranges of the quality tiers, bounds and labels of the alerts.
TIER_RANGES = {"High Quality": (80, 100), "Medium Quality": (50, 79), "Low Quality": (0, 49)}
LOW_SCORES = [(30, "CRITICAL"), (50, "WARNING")]
LEAST_VALID_SHARE = 0.8
DECLINES = [(5, "CRITICAL_DECLINE"), (2, "MODERATE_DECLINE")]
IMPROVEMENTS = [(5, "SIGNIFICANT_IMPROVEMENT")]
NORMAL_CHANGE = "NORMAL_VARIATION"
NOTABLE_GROWTH = 10
LOW_GROWTHS = [(-20, "CRITICAL_DECLINE"), (-10, "MODERATE_DECLINE")]
HIGH_GROWTHS = [(50, "EXCEPTIONAL_GROWTH"), (20, "HIGH_GROWTH")]
NORMAL_GROWTH = "NORMAL_GROWTH"

# Plain reads of a view, some of its first rows only.
READS: dict[str, tuple[str, int | None]] = {
    "read_completeness": ("vw_bronze_vs_silver_completeness", None),
    "read_top_countries": ("vw_top_countries", 10),
    "read_quality_distribution": ("vw_data_quality_distribution", None),
    "read_provider_market_share": ("vw_email_provider_market_share", None),
    "read_monthly_trends": ("vw_monthly_registration_trends", 12),
    "read_quarterly_performance": ("vw_quarterly_registration_performance", None),
    "read_day_patterns": ("vw_registration_day_patterns", None),
    "read_top_growing_countries": ("vw_top_growing_countries", 10),
    "read_quality_trend": ("vw_data_quality_trend_overview", 10),
    "read_anomaly_alerts": ("vw_anomaly_alert_dashboard", None),
}


def _read(view: str, limit: int | None):
    return lambda t: t[view] if limit is None else t[view].limit(limit)


CHECKS.update({name: _read(*what) for name, what in READS.items()})


# --- combinations ----------------------------------------------------------


@check
def segment_x_quality(t: Tables) -> DataFrame:
    """Segments with the quality tier whose score range holds their average.

    The ranges do not overlap, so the range join is an equality join on the
    tier of the average; averages between two ranges belong to none.
    """
    average = F.col("avg_quality_score")
    tier = F.coalesce(*[F.when(average.between(*ends), label) for label, ends in TIER_RANGES.items()])
    segments = t.unordered("vw_target_segment_distribution").withColumn("quality_tier", tier)
    return (
        segments.join(t.unordered("vw_data_quality_distribution"), "quality_tier", "left")
        .select(
            "target_segment", "user_count",
            F.col("percentage").alias("demo_percentage"),
            F.col("count").alias("quality_count"),
            F.col("avg_score").alias("quality_score"),
        )
        .orderBy(down("user_count"), "target_segment")
    )


def _high_engagement(t: Tables) -> Column:
    """The highly engaged generations: at most one row per generation label."""
    high = t.unordered("vw_engagement_by_generation").filter("engagement_tier = 'High'")
    return few_rows(high, "segment_count", "avg_business_email_pct")


@check
def country_x_engagement(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_top_countries")
        .filter("user_count_rank <= 10")
        .withColumn("high", F.explode_outer(_high_engagement(t)))
        .select(
            "country",
            F.col("user_count").alias("country_users"),
            "business_email_percentage",
            F.col("high.segment_count").alias("high_engagement_segments"),
            F.col("high.avg_business_email_pct").alias("engagement_business_email_pct"),
        )
        .orderBy(down("country_users"), "country")
    )


@check
def provider_x_age(t: Tables) -> DataFrame:
    ages = t.unordered("vw_email_provider_age_demographics").select(
        "email_provider_type", F.col("avg_age").alias("provider_avg_age"), "unique_domains"
    )
    shares = t.unordered("vw_email_provider_market_share").select("email_provider_type", "market_share_pct")
    return shares.join(ages, "email_provider_type").orderBy(down("market_share_pct"), "email_provider_type")


@check
def dashboard_top20(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_time_series_executive_dashboard")
        .orderBy(down("processing_date"), down("growth_rate"), "metric_category", up("period"))
        .limit(20)
    )


@check
def expansion_insights(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_geographic_expansion_insights")
        .orderBy(down("total_users"), "expansion_category", "processing_date")
        .select(
            "expansion_category", "countries_in_category", "total_users", "avg_acquisition_rate",
            "avg_market_share", "earliest_entry_date", "latest_entry_date",
        )
    )


@check
def age_trend_top15(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_age_group_trends")
        .filter(F.col("trend_direction").isin("Growing", "Rapidly Growing"))
        .orderBy(
            down("trend_magnitude"), down("registration_year"), "age_group", "generation", "processing_date"
        )
        .limit(15)
        .select(
            "age_group", "generation", "registration_year", "trend_direction", "trend_intensity",
            "trend_magnitude", "total_users_in_group",
        )
    )


# --- business intelligence -------------------------------------------------


@check
def executive_unpivot(t: Tables) -> DataFrame:
    """Four figures of the executive summary as rows, from one read of it."""
    lines = [
        ("Total Users", F.col("total_users"), "users"),
        ("Target Segments", F.col("target_segments"), "segments"),
        ("Geographic Levels", F.col("geographic_levels"), "levels"),
        ("Overall Quality Score", F.round("overall_quality_score", 2), "score"),
    ]
    cells = [c for name, figure, unit in lines for c in (F.lit(name), figure.cast("string"), F.lit(unit))]
    return t.unordered("vw_executive_summary").select(
        F.stack(F.lit(len(lines)), *cells).alias("metric", "value", "unit")
    )


@check
def quality_health_check(t: Tables) -> DataFrame:
    """One row per tier, also for tiers without a batch, from one aggregation."""
    tiers = {
        "Excellent Quality": "Excellent Batch",
        "Good Quality": "Good Batch",
        "Needs Improvement": "Needs Improvement",
    }
    batches = t.unordered("vw_data_quality_batch_distribution")
    counts, cells = [], []
    for position, (label, tier) in enumerate(tiers.items()):
        here = F.col("batch_quality_tier") == tier
        counts += [
            F.count_if(here).alias(f"n{position}"),
            F.round(steady_avg(F.when(here, F.col("avg_score"))), 2).alias(f"a{position}"),
        ]
        cells += [F.lit(label), F.col(f"n{position}"), F.col(f"a{position}")]
    return batches.agg(*counts).select(
        F.stack(F.lit(len(tiers)), *cells).alias("quality_tier", "batch_count", "avg_score")
    )


@check
def country_opportunity(t: Tables) -> DataFrame:
    """Leading countries beside the one city with the highest business share."""
    best = (
        t.unordered("vw_cities_business_email_concentration")
        .orderBy(down("business_email_percentage"), down("user_count"), up("geographic_level"))
        .limit(1)
    )
    city = row_or_null(best, "geographic_level", "business_email_percentage")
    return (
        t.unordered("vw_top_countries")
        .filter("user_count_rank <= 5")
        .select(
            "country", "user_count", "business_email_percentage",
            city["geographic_level"].alias("top_city"),
            city["business_email_percentage"].alias("city_business_pct"),
        )
        .orderBy(down("business_email_percentage"), up("country"))
    )


@check
def age_engagement_rate(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_gender_by_age_group")
        .withColumn("high", F.explode_outer(_high_engagement(t)))
        .select(
            "age_group", "total_users",
            F.col("high.segment_count").alias("high_engagement_count"),
            share(F.col("high.segment_count"), F.col("total_users")).alias("engagement_rate_pct"),
            F.col("high.avg_business_email_pct").alias("avg_business_email_pct"),
        )
        .distinct()
        .orderBy(F.desc_nulls_last("engagement_rate_pct"), "age_group")
    )


@check
def monthly_business_12(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_monthly_business_summary")
        .orderBy(down("month"), down("processing_date"))
        .limit(12)
        .drop("processing_date")
    )


@check
def expansion_timeline_20(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_country_expansion_timeline")
        .orderBy(down("first_user_date"), "country", "processing_date")
        .limit(20)
        .select(
            "country", "first_user_date", "expansion_year", "expansion_month", "user_count",
            "expansion_category", "country_rank_in_year",
        )
    )


@check
def generation_performance_15(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_generation_performance_timeline")
        .orderBy(down("registration_year"), down("total_generation_users"), "generation", "processing_date")
        .limit(15)
        .drop("processing_date")
    )


# --- monitoring ------------------------------------------------------------


@check
def gold_freshness(t: Tables) -> DataFrame:
    return (
        t.unordered("vw_executive_summary")
        .groupBy(F.col("report_generated_at").alias("last_update"))
        .agg(F.lit("Gold Layer Views").alias("layer"), rows().alias("view_count"))
    )


@check
def low_quality_alert(t: Tables) -> DataFrame:
    score = F.col("avg_score")
    severity = label_below(score, LOW_SCORES, "OK")
    return (
        t.unordered("vw_data_quality_batch_distribution")
        .filter((F.col("batch_quality_tier") == "Needs Improvement") | (score < LOW_SCORES[-1][0]))
        .select(
            F.lit("LOW_QUALITY_ALERT").alias("alert_type"),
            "batch_quality_tier", "batch_count", "avg_score", severity.alias("severity"),
        )
    )


@check
def completeness_alert(t: Tables) -> DataFrame:
    """The silver row carries no presence counts, so its comparison is null and it stays OK."""
    silver = F.col("layer") == "Silver Layer"
    low_email = F.col("emails_valid") < F.col("emails_present") * LEAST_VALID_SHARE
    low_phone = F.col("phones_valid") < F.col("phones_present") * LEAST_VALID_SHARE
    status = (
        F.when(silver & low_email, "EMAIL_VALIDATION_LOW")
        .when(silver & low_phone, "PHONE_VALIDATION_LOW")
        .otherwise("OK")
    )
    return t.unordered("vw_bronze_vs_silver_completeness").select(
        F.lit("COMPLETENESS_COMPARISON").alias("alert_type"), "*", status.alias("alert_status")
    )


def _severe(anomalies: DataFrame, alert: str, columns: list[str]) -> DataFrame:
    return (
        anomalies.filter(F.col("anomaly_severity").isin("Critical", "High"))
        .select(F.lit(alert).alias("alert_type"), *columns)
        .orderBy(down("z_score"), down("processing_date"))
    )


@check
def registration_anomaly_alert(t: Tables) -> DataFrame:
    columns = [
        "period_type", "time_period", "registrations", "z_score", "anomaly_severity", "action_required",
        "processing_date",
    ]
    return _severe(t.unordered("vw_registration_anomalies_summary"), "REGISTRATION_ANOMALY", columns)


@check
def quality_anomaly_alert(t: Tables) -> DataFrame:
    columns = [
        "processing_date", "avg_quality_score", "z_score", "anomaly_severity", "quality_status", "total_records",
    ]
    return _severe(t.unordered("vw_quality_anomalies_summary"), "QUALITY_ANOMALY", columns)


@check
def quality_trend_alert(t: Tables) -> DataFrame:
    direction, size = F.col("change_direction"), F.col("change_magnitude")
    level = F.when(direction == "Negative", label_above(size, DECLINES, NORMAL_CHANGE)).otherwise(
        label_above(size, IMPROVEMENTS, NORMAL_CHANGE)
    )
    return (
        t.unordered("vw_quality_improvement_tracking")
        .filter(direction != "Neutral")
        .orderBy(down("processing_date"), down("change_magnitude"))
        .limit(10)
        .select(
            F.lit("QUALITY_TREND_ALERT").alias("alert_type"),
            "processing_date", "quality_trend", "change_direction", "change_magnitude",
            "high_quality_percentage", level.alias("trend_alert_level"),
        )
    )


@check
def growth_rate_alert(t: Tables) -> DataFrame:
    growth = F.col("growth_rate")
    level = label_below(growth, LOW_GROWTHS, label_above(growth, HIGH_GROWTHS, NORMAL_GROWTH))
    return (
        t.unordered("vw_monthly_registration_trends")
        .filter(growth.isNull() | (F.abs(growth) > NOTABLE_GROWTH))
        .orderBy(down("processing_date"), F.abs(growth).desc_nulls_first(), down("time_period"))
        .limit(15)
        .select(
            F.lit("GROWTH_RATE_ALERT").alias("alert_type"),
            "time_period", "registrations", "growth_rate", "growth_category", level.alias("growth_alert_level"),
        )
    )


# --- time series combinations ----------------------------------------------


@check
def registration_x_quality(t: Tables) -> DataFrame:
    quality = t.unordered("vw_data_quality_trend_overview").select(
        "processing_date", "avg_quality_score", "quality_change", "quality_trend"
    )
    growth, change = F.col("registration_growth"), F.col("quality_change")
    combined = (
        F.when((growth > 0) & (change > 0), "Growth with Quality Improvement")
        .when((growth > 0) & (change < 0), "Growth with Quality Decline")
        .when((growth < 0) & (change > 0), "Decline with Quality Improvement")
        .when((growth < 0) & (change < 0), "Decline with Quality Decline")
        .otherwise("Mixed or Stable")
    )
    months = t.unordered("vw_monthly_registration_trends").select(
        F.col("time_period").alias("month"),
        "registrations",
        F.col("growth_rate").alias("registration_growth"),
        "processing_date",
    )
    return (
        months.join(quality, "processing_date", "left")
        .withColumn("combined_trend_analysis", combined)
        .orderBy(down("month"), down("processing_date"))
        .limit(12)
        .drop("processing_date")
    )


@check
def demographics_x_expansion(t: Tables) -> DataFrame:
    expansion = t.unordered("vw_geographic_expansion_insights").select(
        "processing_date", "expansion_category", "avg_acquisition_rate",
        F.col("total_users").alias("geo_total_users"),
    )
    return (
        t.unordered("vw_fastest_growing_demographics")
        .filter("growth_rank <= 5")
        .select("age_group", "generation", "trend_magnitude", "total_users_in_group", "processing_date")
        .join(expansion, "processing_date", "left")
        .orderBy(down("trend_magnitude"), "age_group", "generation", "expansion_category")
        .drop("processing_date")
    )


@check
def penetration_x_days(t: Tables) -> DataFrame:
    """Every expansion category and batch beside the three most popular weekdays."""
    days = (
        t.unordered("vw_registration_day_patterns")
        .filter("popularity_rank <= 3")
        .select("day_name", F.col("registrations").alias("day_registrations"), "percentage_of_weekly_registrations")
    )
    categories = t.unordered("vw_market_penetration_analysis").select(
        "expansion_category", F.col("country_count").alias("countries_in_category"), "total_users", "processing_date"
    )
    return (
        beside_every(categories, days)
        .drop("processing_date")
        .orderBy(down("total_users"), down("percentage_of_weekly_registrations"))
    )


# --- health ----------------------------------------------------------------


@check
def pipeline_health(t: Tables) -> DataFrame:
    """Figures of the joined monthly, expansion, quality and anomaly tables.

    The figures are those of the row-level join of the five tables on the
    batch, in which each row appears once for every combination of the other
    tables' rows. The combinations are counted per batch instead of being
    made, so every join has one row per batch on both sides.
    """
    months = t["fact_registration_trends"].filter("period_type = 'monthly'")
    countries = t["fact_geographic_expansion"]
    quality = t["fact_data_quality_trends"]

    def exact(name: str) -> Column:
        # Times a weight of 19 digits this stays within the 38 digits of a decimal.
        return F.col(name).cast("decimal(18,8)")

    def batches(rows_of: DataFrame, *figures: Column) -> DataFrame:
        return rows_of.groupBy("processing_date").agg(*figures)

    per_batch = batches(
        months,
        rows().alias("months"),
        F.sum("registrations").alias("registrations"),
        F.sum(exact("growth_rate")).cast("decimal(18,8)").alias("growth"),
        F.count("growth_rate").alias("growths"),
    )
    others = [
        batches(countries, rows().alias("countries")),
        batches(
            quality, rows().alias("qualities"), F.sum(exact("avg_quality_score")).cast("decimal(18,8)").alias("score"),
            F.count("avg_quality_score").alias("scores"),
        ),
        batches(t["fact_registration_anomalies"].filter("is_anomaly"), rows().alias("low_months")),
        batches(t["fact_quality_anomalies"].filter("is_anomaly"), rows().alias("low_qualities")),
    ]
    for other in others:
        per_batch = per_batch.join(other, "processing_date", "left")

    def copies(*names: str) -> Column:
        """Copies a left join makes of a row: the product of matches, at least one each."""
        product = F.lit(1).cast("bigint")
        for name in names:
            product = product * F.coalesce(name, F.lit(1))
        return product

    def average(total: str, present: str, *by: str) -> Column:
        weight = copies(*by).cast("decimal(19,0)")
        return F.try_divide(
            F.sum(F.col(total) * weight).cast("double"), F.sum(F.col(present) * weight).cast("double")
        )

    def occurrences(name: str, *by: str) -> Column:
        return F.coalesce(F.sum(F.col(name) * copies(*by)), F.lit(0))

    around_months = ["countries", "qualities", "low_months", "low_qualities"]
    reached = countries.join(months.select("processing_date").distinct(), "processing_date", "left_semi")
    return per_batch.agg(
        average("registrations", "months", *around_months).alias("avg_monthly_registrations"),
        average("growth", "growths", *around_months).alias("avg_growth_rate"),
        average("score", "scores", "months", "countries", "low_months", "low_qualities").alias(
            "avg_quality_score"
        ),
        occurrences("low_months", "months", "countries", "qualities", "low_qualities").alias(
            "registration_anomalies"
        ),
        occurrences("low_qualities", "months", "countries", "qualities", "low_months").alias(
            "quality_anomalies"
        ),
    ).select(
        F.lit("Pipeline Health Check").alias("report_type"),
        months.select(F.countDistinct("time_period")).scalar().alias("months_with_data"),
        "avg_monthly_registrations", "avg_growth_rate",
        reached.select(F.countDistinct("country")).scalar().alias("countries_active"),
        "avg_quality_score", "registration_anomalies", "quality_anomalies",
        t.ctx.timestamp().alias("report_generated_at"),
    )


@check
def timeseries_completeness(t: Tables) -> DataFrame:
    tables = {
        "Age Demographic Trends": "fact_age_demographic_trends",
        "Data Quality Trends": "fact_data_quality_trends",
        "Geographic Expansion": "fact_geographic_expansion",
        "Registration Trends": "fact_registration_trends",
    }
    parts = [
        t[table].agg(
            F.lit("Time Series Completeness").alias("check_type"),
            F.lit(label).alias("table_name"),
            rows().alias("total_records"),
            F.countDistinct("processing_date").alias("unique_dates"),
            F.min("processing_date").alias("earliest_date"),
            F.max("processing_date").alias("latest_date"),
        )
        for label, table in tables.items()
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined.orderBy("table_name")
