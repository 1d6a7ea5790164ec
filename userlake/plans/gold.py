"""Business views over the silver tables."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from userlake.functions.measures import (
    down, label_above, label_below, label_from, label_of, label_up_to, rows, share, steady_avg, tally, up,
)
from userlake.functions.scoring import demographic_score, quality_tier, target_segment
from userlake.operators.ranking import rising, with_range_number
from userlake.plans.naming import ordered_collector

if TYPE_CHECKING:
    from userlake.tables import Tables

VIEWS: dict = {}
ORDERS: dict[str, tuple[str, ...]] = {}
view = ordered_collector(VIEWS, ORDERS)


# Bounds and labels of the views.
EXCELLENT_BATCH = (50, "Excellent Batch")
GOOD_BATCH = (70, "Good Batch")
POOR_BATCH = "Needs Improvement"
GROWING = [(20, "High Growth"), (0, "Growing")]
SHRINKING = [(-10, "Declining")]
STEADY = "Stable"
QUARTER_TIERS = [(2, "Top Performer"), (4, "Good Performer")]
LAST_QUARTER_TIER = "Needs Improvement"
RAPID_CHANGE = 5
SIGNIFICANT_CHANGE = 2
REGISTRATION_ACTIONS = {
    "Critical": "Immediate Attention Required",
    "High": "Investigation Recommended",
    "Medium": "Monitor Closely",
}
NO_ACTION = "Normal Variation"
QUALITY_STATES = {
    "Critical": "Data Quality Crisis",
    "High": "Quality Issue Detected",
    "Medium": "Quality Variation",
}
NORMAL_STATE = "Normal Quality Range"
SMALLEST_CITY, SMALLEST_DOMAIN = 5, 2


def _rounded(name: str, digits: int) -> Column:
    return F.round(name, digits).alias(name)


# --- users -----------------------------------------------------------------


@view("age_group", "generation")
def vw_age_generation_distribution(t: Tables) -> DataFrame:
    groups = t["users_transformed"].groupBy("age_group", "generation").agg(rows().alias("user_count"))
    # The window holds at most age groups x generations.
    everyone = F.sum("user_count").over(W.partitionBy())
    return groups.withColumn("percentage", share(F.col("user_count"), everyone))


@view("-avg_score")
def vw_data_quality_distribution(t: Tables) -> DataFrame:
    score = F.col("data_quality_score")
    return (
        t["users_transformed"]
        .groupBy(quality_tier(score).alias("quality_tier"))
        .agg(rows().alias("count"), F.avg(score).alias("avg_score"))
    )


@view("-user_count", "email_provider_type")
def vw_email_provider_analysis(t: Tables) -> DataFrame:
    return (
        t["users_transformed"]
        .groupBy("email_provider_type")
        .agg(rows().alias("user_count"), F.countDistinct("email_domain").alias("unique_domains"))
    )


# --- demographics ----------------------------------------------------------


@view("-user_count", "target_segment")
def vw_target_segment_distribution(t: Tables) -> DataFrame:
    segments = t["dim_user_demographics"].groupBy("target_segment").agg(
        rows().alias("user_count"), F.avg("data_quality_score").alias("avg_quality_score")
    )
    # The window holds one row per segment label.
    everyone = F.sum("user_count").over(W.partitionBy())
    return segments.select(
        "target_segment",
        "user_count",
        share(F.col("user_count"), everyone).alias("percentage"),
        "avg_quality_score",
    )


@view("generation", "age_group")
def vw_demographics_by_generation_age(t: Tables) -> DataFrame:
    return (
        t["dim_user_demographics"]
        .groupBy("generation", "age_group")
        .agg(
            rows().alias("users"),
            F.countDistinct("country").alias("countries"),
            F.avg("demographic_score").alias("avg_demographic_score"),
        )
    )


# --- geography -------------------------------------------------------------


@view("-user_count", "country", "user_count_rank", "avg_age", "male_percentage", "business_email_percentage")
def vw_top_countries(t: Tables) -> DataFrame:
    countries = t["fact_geographic_analysis"].filter("analysis_type = 'country'")
    return countries.select(
        F.col("geographic_level").alias("country"),
        "user_count", "avg_age", "male_percentage", "female_percentage",
        "business_email_percentage", "user_count_rank",
    )


@view()
def vw_geographic_diversity(t: Tables) -> DataFrame:
    return t["fact_geographic_analysis"].groupBy("analysis_type").agg(
        rows().alias("total_locations"),
        F.sum("user_count").alias("total_users"),
        steady_avg(F.col("avg_age")).alias("global_avg_age"),
        steady_avg(F.col("business_email_percentage")).alias("avg_business_email_pct"),
    )


@view("-business_email_percentage", "geographic_level")
def vw_cities_business_email_concentration(t: Tables) -> DataFrame:
    return (
        t["fact_geographic_analysis"]
        .filter((F.col("analysis_type") == "city") & (F.col("user_count") >= SMALLEST_CITY))
        .select("geographic_level", "user_count", "business_email_percentage", "avg_data_quality")
    )


# --- age and generation ----------------------------------------------------


@view("generation", "engagement_tier")
def vw_engagement_by_generation(t: Tables) -> DataFrame:
    return (
        t["fact_age_generation_analysis"]
        .groupBy("generation", "engagement_tier")
        .agg(
            rows().alias("segment_count"),
            steady_avg(F.col("avg_account_age_days")).alias("avg_account_age"),
            steady_avg(F.col("business_email_percentage")).alias("avg_business_email_pct"),
            steady_avg(F.col("veteran_percentage")).alias("avg_veteran_pct"),
        )
    )


@view("age_group", "gender")
def vw_gender_by_age_group(t: Tables) -> DataFrame:
    return (
        t["fact_age_generation_analysis"]
        .groupBy("age_group", "gender")
        .agg(
            F.sum("user_count").alias("total_users"),
            steady_avg(F.col("avg_data_quality")).alias("avg_quality"),
            F.avg("countries_represented").alias("avg_countries_represented"),
        )
    )


@view("-engagement_score", "age_group", "generation", "gender")
def vw_high_engagement_segments(t: Tables) -> DataFrame:
    return (
        t["fact_age_generation_analysis"]
        .filter("engagement_tier = 'High'")
        .select(
            "age_group", "generation", "gender", "user_count", "engagement_score",
            "business_email_percentage", "veteran_percentage",
        )
    )


# --- e-mail ----------------------------------------------------------------


@view("-total_users", "email_provider_type")
def vw_email_provider_market_share(t: Tables) -> DataFrame:
    providers = t["fact_email_provider_analysis"]
    # The window holds one row per provider type and batch.
    everyone = F.sum("total_users").over(W.partitionBy())
    return providers.select(
        "email_provider_type", "total_users", "unique_domains",
        share(F.col("total_users"), everyone).alias("market_share_pct"),
        "avg_age", "countries_represented",
    )


@view("-market_share_percentage", "email_domain")
def vw_top_email_domains(t: Tables) -> DataFrame:
    return (
        t["fact_email_domain_analysis"]
        .filter(F.col("user_count") >= SMALLEST_DOMAIN)
        .select(
            "email_domain", "email_provider_type", "user_count", "market_share_percentage",
            "avg_user_age", "countries_using", "gender_ratio_male_female",
        )
    )


@view("-total_users", "email_provider_type")
def vw_email_provider_age_demographics(t: Tables) -> DataFrame:
    return (
        t["fact_email_domain_analysis"]
        .groupBy("email_provider_type")
        .agg(
            F.round(steady_avg(F.col("avg_user_age")), 1).alias("avg_age"),
            F.countDistinct("email_domain").alias("unique_domains"),
            F.sum("user_count").alias("total_users"),
            F.round(steady_avg(F.col("gender_ratio_male_female")), 2).alias("avg_gender_ratio"),
        )
    )


# --- data quality ----------------------------------------------------------


@view("-processing_date")
def vw_data_quality_metrics(t: Tables) -> DataFrame:
    return (
        t["fact_data_quality_metrics"]
        .select(
            "processing_date", "total_records", "excellent_quality_percentage", "good_quality_percentage",
            "email_validity_percentage", "phone_validity_percentage", "data_completeness_score",
            "avg_quality_score",
        )
    )


@view("-avg_segment_quality", "age_group", "generation")
def vw_quality_by_segment(t: Tables) -> DataFrame:
    """Segment rows once per target segment that occurs in their age group and generation."""
    targets = t["dim_user_demographics"].select("age_group", "generation", "target_segment").distinct()
    segments = t["fact_quality_by_segment"].select(
        "age_group", "generation", "segment_total", "avg_segment_quality",
        "segment_email_validity_rate", "segment_phone_validity_rate",
    )
    return segments.join(targets, ["age_group", "generation"], "left")


@view()
def vw_data_quality_batch_distribution(t: Tables) -> DataFrame:
    excellent, good = F.col("excellent_quality_percentage"), F.col("good_quality_percentage")
    tier = label_from(excellent, [EXCELLENT_BATCH], label_from(good + excellent, [GOOD_BATCH], POOR_BATCH))
    return t["fact_data_quality_metrics"].groupBy(tier.alias("batch_quality_tier")).agg(
        rows().alias("batch_count"),
        steady_avg(F.col("avg_quality_score")).alias("avg_score"),
        steady_avg(F.col("data_completeness_score")).alias("avg_completeness"),
    )


# --- raw against cleaned ---------------------------------------------------


@view()
def vw_bronze_vs_silver_completeness(t: Tables) -> DataFrame:
    absent = F.lit(None).cast("bigint")
    bronze = t["raw_users"].agg(
        F.lit("Bronze Layer").alias("layer"),
        rows().alias("record_count"),
        F.count("email").alias("emails_present"),
        F.count("phone").alias("phones_present"),
        absent.alias("emails_valid"),
        absent.alias("phones_valid"),
    )
    silver = t["users_transformed"].agg(
        F.lit("Silver Layer").alias("layer"),
        rows().alias("record_count"),
        absent.alias("emails_present"),
        absent.alias("phones_present"),
        tally(F.col("email_valid")).alias("emails_valid"),
        tally(F.col("phone_valid")).alias("phones_valid"),
    )
    return bronze.unionByName(silver)


@view()
def vw_data_enrichment_impact(t: Tables) -> DataFrame:
    def labelled(users: DataFrame, kind: str, level: str) -> DataFrame:
        return users.agg(
            F.lit(kind).alias("data_type"), rows().alias("record_count"), F.lit(level).alias("enrichment_level")
        )

    # The labels.
    before = labelled(t["raw_users"], "Raw Data Fields", "Basic user info only")
    after = labelled(
        t["users_transformed"],
        "Enriched Data Fields",
        "Added: age_group, generation, email_provider_type, data_quality_score, account_tenure_category",
    )
    return before.unionByName(after)


@view()
def vw_executive_summary(t: Tables) -> DataFrame:
    """Figures over all batches, from one row per batch.

    What the segment, location and provider tables hold follows from the
    labels of each batch's users, which are few by definition, so the users are
    read once for all of them.
    """
    daily = t["users_transformed"].groupBy("processing_date").agg(
        rows().alias("users"),
        F.collect_set(target_segment(demographic_score())).alias("segments"),
        F.collect_set("email_provider_type").alias("providers"),
    )
    total = F.coalesce(F.sum("users"), F.lit(0))
    quality = t.unordered("fact_data_quality_metrics").select(F.round(steady_avg(F.col("avg_quality_score")), 2)).scalar()
    return daily.agg(
        total.alias("total_users"),
        F.size(F.array_distinct(F.flatten(F.collect_list("segments")))).cast("bigint").alias("target_segments"),
        # Users have a country row and a city row, whatever their address.
        F.when(total > 0, 2).otherwise(0).cast("bigint").alias("geographic_levels"),
        F.coalesce(F.sum(F.size("providers")), F.lit(0)).cast("bigint").alias("email_provider_types"),
    ).select(
        "total_users", "target_segments", "geographic_levels", quality.alias("overall_quality_score"),
        "email_provider_types", t.ctx.timestamp().alias("report_generated_at"),
    )


# --- registration trends ---------------------------------------------------


def _periods(t: Tables, kind: str) -> DataFrame:
    return t["fact_registration_trends"].filter(F.col("period_type") == kind)


@view("-time_period", "-processing_date")
def vw_monthly_registration_trends(t: Tables) -> DataFrame:
    growth = F.col("growth_rate")
    category = label_above(growth, GROWING, label_below(growth, SHRINKING, STEADY))
    return (
        _periods(t, "monthly")
        .select(
            "time_period", "registrations", "countries_represented", _rounded("avg_age_at_registration", 1),
            "male_percentage", "female_percentage", _rounded("avg_data_quality", 1),
            "growth_rate", category.alias("growth_category"), "processing_date",
        )
    )


@view("-time_period", "-processing_date")
def vw_quarterly_registration_performance(t: Tables) -> DataFrame:
    # The window holds one row per quarter and batch.
    rank = F.rank().over(W.orderBy(down("registrations")))
    return (
        _periods(t, "quarterly")
        .select(
            "time_period", "registrations", "countries_represented", _rounded("avg_age_at_registration", 1),
            "growth_rate", rank.alias("performance_rank"), "processing_date",
        )
        .withColumn(
            "performance_tier", label_up_to(F.col("performance_rank"), QUARTER_TIERS, LAST_QUARTER_TIER)
        )
    )


@view("-registrations", "day_name", "processing_date")
def vw_registration_day_patterns(t: Tables) -> DataFrame:
    # Both windows hold one row per weekday and batch.
    everyone = F.sum("registrations").over(W.partitionBy())
    return (
        _periods(t, "day_of_week")
        .select(
            F.col("time_period").alias("day_name"),
            "registrations", _rounded("avg_age_at_registration", 1), _rounded("avg_data_quality", 1),
            F.rank().over(W.orderBy(down("registrations"))).alias("popularity_rank"),
            share(F.col("registrations"), everyone).alias("percentage_of_weekly_registrations"),
            "processing_date",
        )
    )


# --- geographic expansion --------------------------------------------------


@view("-user_acquisition_rate", "country", "processing_date")
def vw_top_growing_countries(t: Tables) -> DataFrame:
    return (
        t["fact_geographic_expansion"]
        .filter(F.col("expansion_category").isin("Top Tier", "Mid Tier"))
        .select(
            "country", "user_count", "user_acquisition_rate", "market_share_percentage", "expansion_category",
            "cities_represented", _rounded("avg_user_age", 1), _rounded("avg_data_quality", 1),
            "days_since_first_user", "first_user_date", "user_count_rank", "expansion_rate_rank",
            "processing_date",
        )
    )


@view("-total_users", "expansion_category", "processing_date")
def vw_market_penetration_analysis(t: Tables) -> DataFrame:
    return (
        t["fact_geographic_expansion"]
        .groupBy("expansion_category", "processing_date")
        .agg(
            rows().alias("country_count"),
            F.sum("user_count").alias("total_users"),
            F.round(steady_avg(F.col("market_share_percentage")), 2).alias("avg_market_share"),
            F.round(steady_avg(F.col("user_acquisition_rate")), 4).alias("avg_acquisition_rate"),
            F.round(F.avg("cities_represented"), 1).alias("avg_cities_per_country"),
            F.min("first_user_date").alias("earliest_expansion_date"),
            F.max("first_user_date").alias("latest_expansion_date"),
        )
    )


@view("first_user_date", "country_rank_in_year")
def vw_country_expansion_timeline(t: Tables) -> DataFrame:
    dated = t["fact_geographic_expansion"].select(
        "country", "first_user_date", "user_count", "user_acquisition_rate", "expansion_category",
        F.year("first_user_date").alias("expansion_year"),
        F.month("first_user_date").alias("expansion_month"),
        "processing_date",
    )
    # A year holds the countries of all batches, so it is numbered in ranges, not in one task.
    order = [*rising(F.col("first_user_date")), F.col("country"), F.col("processing_date")]
    return with_range_number(dated, "country_rank_in_year", group=["expansion_year"], order=order)


# --- age trends ------------------------------------------------------------


@view("-registration_year", "-trend_magnitude", "age_group", "generation", "processing_date")
def vw_age_group_trends(t: Tables) -> DataFrame:
    direction, rapid = F.col("trend_direction"), F.col("trend_magnitude") > RAPID_CHANGE
    # The labels.
    intensity = (
        F.when((direction == "Growing") & rapid, "Rapidly Growing")
        .when((direction == "Declining") & rapid, "Rapidly Declining")
        .otherwise(direction)
    )
    return (
        t["fact_age_demographic_trends"]
        .select(
            "age_group", "generation", "registration_year", "total_users_in_group", "percentage_of_year",
            "trend_direction", _rounded("trend_magnitude", 2), intensity.alias("trend_intensity"),
            _rounded("avg_data_quality", 1), "total_countries", "processing_date",
        )
    )


@view("-registration_year", "-total_generation_users", "generation", "processing_date")
def vw_generation_performance_timeline(t: Tables) -> DataFrame:
    return (
        t["fact_age_demographic_trends"]
        .groupBy("generation", "registration_year", "processing_date")
        .agg(
            F.sum("total_users_in_group").alias("total_generation_users"),
            F.round(steady_avg(F.col("percentage_of_year")), 2).alias("avg_percentage_of_year"),
            F.countDistinct("age_group").alias("age_groups_represented"),
            F.round(steady_avg(F.col("avg_data_quality")), 1).alias("avg_data_quality"),
            F.sum("total_countries").alias("total_countries_reached"),
        )
    )


@view("-registration_year", "-trend_magnitude", "age_group", "generation", "processing_date")
def vw_fastest_growing_demographics(t: Tables) -> DataFrame:
    # The window holds age groups x generations x batches of one year.
    of_year = W.partitionBy("registration_year").orderBy(down("trend_magnitude"))
    return (
        t["fact_age_demographic_trends"]
        .filter("trend_direction = 'Growing'")
        .select(
            "age_group", "generation", "registration_year", "total_users_in_group", "trend_magnitude",
            "trend_direction", "percentage_of_year", F.rank().over(of_year).alias("growth_rank"),
            "processing_date",
        )
    )


# --- quality trends --------------------------------------------------------


@view("-processing_date")
def vw_data_quality_trend_overview(t: Tables) -> DataFrame:
    trend, change = F.col("quality_trend"), F.col("quality_change")
    # The labels.
    intensity = (
        F.when((trend == "Improving") & (change > SIGNIFICANT_CHANGE), "Significantly Improving")
        .when((trend == "Declining") & (change < -SIGNIFICANT_CHANGE), "Significantly Declining")
        .otherwise(trend)
    )
    # The window holds one row per batch.
    previous = F.lag("avg_quality_score").over(W.orderBy("processing_date"))
    return (
        t["fact_data_quality_trends"]
        .select(
            "processing_date", "total_records", _rounded("avg_quality_score", 2),
            "excellent_quality_percentage", "good_quality_percentage",
            "email_validity_percentage", "phone_validity_percentage",
            "quality_trend", _rounded("quality_change", 2), intensity.alias("quality_trend_intensity"),
            previous.alias("previous_avg_quality"),
        )
    )


@view("-processing_date")
def vw_quality_improvement_tracking(t: Tables) -> DataFrame:
    change = F.col("quality_change")
    high = F.col("excellent_quality_count") + F.col("good_quality_count")
    return (
        t["fact_data_quality_trends"]
        .select(
            "processing_date", "avg_quality_score", "quality_change", "quality_trend",
            F.when(change > 0, "Positive").when(change < 0, "Negative").otherwise("Neutral").alias(
                "change_direction"
            ),
            F.abs(change).alias("change_magnitude"),
            high.alias("high_quality_records"),
            share(high, F.col("total_records")).alias("high_quality_percentage"),
            "total_records",
        )
    )


# --- anomalies -------------------------------------------------------------


@view("-z_score", "-processing_date")
def vw_registration_anomalies_summary(t: Tables) -> DataFrame:
    action = label_of(F.col("anomaly_severity"), REGISTRATION_ACTIONS, NO_ACTION)
    return (
        t["fact_registration_anomalies"]
        .filter("is_anomaly")
        .select(
            "period_type", "time_period", "registrations", _rounded("z_score", 2), "anomaly_type",
            "anomaly_severity", "growth_rate", action.alias("action_required"), "processing_date",
        )
    )


@view("-z_score", "-processing_date")
def vw_quality_anomalies_summary(t: Tables) -> DataFrame:
    status = label_of(F.col("anomaly_severity"), QUALITY_STATES, NORMAL_STATE)
    return (
        t["fact_quality_anomalies"]
        .filter("is_anomaly")
        .select(
            "processing_date", _rounded("avg_quality_score", 2), _rounded("z_score", 2), "anomaly_type",
            "anomaly_severity", "quality_trend", _rounded("quality_change", 2),
            status.alias("quality_status"), "total_records",
        )
    )


# --- dashboards ------------------------------------------------------------


@view("-processing_date")
def vw_time_series_executive_dashboard(t: Tables) -> DataFrame:
    def lines(df: DataFrame, category: str, kind: str, period: str, value: str, growth: Column) -> DataFrame:
        return df.select(
            F.lit(category).alias("metric_category"),
            F.lit(kind).alias("metric_type"),
            F.col(period).cast("string").alias("period"),
            F.col(value).cast("string").alias("value"),
            growth.alias("growth_rate"),
            "processing_date",
        )

    zero = F.lit(0.0)
    leaders = t["fact_geographic_expansion"].filter("user_count_rank <= 5")
    parts = [
        lines(_periods(t, "monthly"), "Registration Growth", "Monthly", "time_period", "registrations",
              F.coalesce("growth_rate", zero)),
        lines(leaders, "Geographic Expansion", "Top Countries", "country", "user_count",
              F.col("user_acquisition_rate")),
        lines(t["fact_data_quality_trends"], "Data Quality", "Trend", "processing_date", "avg_quality_score",
              F.coalesce("quality_change", zero)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@view("-processing_date", "-z_score")
def vw_anomaly_alert_dashboard(t: Tables) -> DataFrame:
    def alerts(name: str, category: str, identifier: str, metric: str) -> DataFrame:
        severe = t[name].filter(F.col("is_anomaly") & F.col("anomaly_severity").isin("Critical", "High"))
        return severe.select(
            F.lit(category).alias("anomaly_category"),
            F.col(identifier).cast("string").alias("identifier"),
            F.col("anomaly_severity").alias("severity"),
            F.col("anomaly_type").alias("type"),
            "z_score",
            F.col(metric).cast("double").alias("metric_value"),
            "processing_date",
        )

    registrations = alerts("fact_registration_anomalies", "Registration", "time_period", "registrations")
    quality = alerts("fact_quality_anomalies", "Data Quality", "processing_date", "avg_quality_score")
    return registrations.unionByName(quality)


@view("-month", "-processing_date")
def vw_monthly_business_summary(t: Tables) -> DataFrame:
    quality = t["fact_data_quality_trends"].select(
        "processing_date",
        F.col("avg_quality_score").alias("data_quality_score"),
        F.col("quality_trend").alias("quality_direction"),
    )
    growth, direction = F.col("registration_growth_rate"), F.col("quality_direction")
    improving, declining = direction == "Improving", direction == "Declining"
    performance = (
        F.when((growth > 0) & improving, "Excellent")
        .when((growth > 0) | improving, "Good")
        .when((growth < -10) | declining, "Needs Attention")
        .otherwise("Stable")
    )
    months = _periods(t, "monthly").select(
        F.col("time_period").alias("month"),
        F.col("registrations").alias("new_registrations"),
        F.col("growth_rate").alias("registration_growth_rate"),
        F.col("countries_represented").alias("countries_active"),
        F.round("avg_age_at_registration", 1).alias("avg_new_user_age"),
        "processing_date",
    )
    return (
        months.join(quality, "processing_date", "left")
        .withColumn("overall_performance", performance)
    )


@view("-total_users", "expansion_category", "processing_date")
def vw_geographic_expansion_insights(t: Tables) -> DataFrame:
    return (
        t["fact_geographic_expansion"]
        .groupBy("expansion_category", "processing_date")
        .agg(
            rows().alias("countries_in_category"),
            F.sum("user_count").alias("total_users"),
            F.round(steady_avg(F.col("user_acquisition_rate")), 4).alias("avg_acquisition_rate"),
            F.round(steady_avg(F.col("market_share_percentage")), 2).alias("avg_market_share"),
            F.min("first_user_date").alias("earliest_entry_date"),
            F.max("first_user_date").alias("latest_entry_date"),
            F.round(steady_avg(F.col("avg_user_age")), 1).alias("avg_user_age_in_category"),
        )
    )
