"""Short reports that close the batch jobs."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.functions.measures import rows, share
from userlake.functions.scoring import quality_tier
from userlake.plans.naming import collector

if TYPE_CHECKING:
    from userlake.tables import Tables

REPORTS: dict = {}
report = collector(REPORTS)


@report
def age_generation_pct(t: Tables) -> DataFrame:
    groups = t["users_transformed"].groupBy("age_group", "generation").agg(rows().alias("count"))
    everyone = t["users_transformed"].select(rows()).scalar()
    return groups.withColumn("percentage", share(F.col("count"), everyone)).orderBy("age_group", "generation")


@report
def quality_tier_distribution(t: Tables) -> DataFrame:
    score = F.col("data_quality_score")
    tiers = t["users_transformed"].groupBy(quality_tier(score).alias("quality_tier"))
    return tiers.agg(rows().alias("count"), F.avg(score).alias("avg_score")).orderBy(F.desc("avg_score"))


@report
def report_segment_counts(t: Tables) -> DataFrame:
    return t["dim_user_demographics"].groupBy("target_segment").count()


@report
def report_top5_countries(t: Tables) -> DataFrame:
    countries = t["fact_geographic_analysis"].filter("analysis_type = 'country'")
    return countries.orderBy(F.desc("user_count"), "geographic_level", "processing_date").limit(5)


@report
def report_engagement_counts(t: Tables) -> DataFrame:
    return t["fact_age_generation_analysis"].groupBy("engagement_tier").count()


@report
def report_providers(t: Tables) -> DataFrame:
    return t["fact_email_provider_analysis"].orderBy(F.desc("total_users"), "email_provider_type")


@report
def report_quality_row(t: Tables) -> DataFrame:
    return t["fact_data_quality_metrics"].select(
        "total_records", "avg_quality_score", "excellent_quality_percentage", "email_validity_percentage"
    )


@report
def report_last6_months(t: Tables) -> DataFrame:
    monthly = t["fact_registration_trends"].filter("period_type = 'monthly'")
    return monthly.orderBy(F.desc("time_period"), F.desc("processing_date")).limit(6)


@report
def report_fastest5_countries(t: Tables) -> DataFrame:
    return (
        t["fact_geographic_expansion"]
        .orderBy(F.desc("user_acquisition_rate"), "country", "processing_date")
        .limit(5)
    )


@report
def report_growing5_age_groups(t: Tables) -> DataFrame:
    growing = t["fact_age_demographic_trends"].filter("trend_direction = 'Growing'")
    return growing.orderBy(
        F.desc("trend_magnitude"), F.desc("registration_year"), "age_group", "generation", "processing_date"
    ).limit(5)


@report
def report_recent3_quality(t: Tables) -> DataFrame:
    return t["fact_data_quality_trends"].orderBy(F.desc("processing_date")).limit(3)


@report
def report_anomaly_counts(t: Tables) -> DataFrame:
    def found(name: str, label: str) -> DataFrame:
        marked = t[name].agg(F.count_if("is_anomaly").alias("anomalies"))
        return marked.select(F.lit(label).alias("anomaly_source"), "anomalies")

    return found("fact_registration_anomalies", "Registration").unionByName(
        found("fact_quality_anomalies", "Data Quality")
    )
