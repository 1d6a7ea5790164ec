"""Point scores and the tiers read off them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from userlake.functions.measures import label_above, label_from, label_up_to

# Attribute values that earn points, points with and without them.
DEMOGRAPHIC_POINTS = [
    ("age_group", ["25-34", "35-44"], 10, 5),
    ("generation", ["Millennial", "Gen X"], 10, 5),
    ("email_provider_type", ["Business"], 15, 5),
    ("account_tenure_category", ["Veteran"], 20, 10),
]
# Measures that earn points above a bound, points above and up to it.
ENGAGEMENT_POINTS = [
    ("avg_account_age_days", 365, 20, 10),
    ("business_email_percentage", 50, 15, 5),
    ("avg_data_quality", 80, 10, 5),
    ("countries_represented", 1, 5, 0),
]
# Tier bounds and labels.
SEGMENTS = [(40, "Premium"), (25, "Standard")]
LOWEST_SEGMENT = "Basic"
ENGAGEMENT_TIERS = [(35, "High"), (20, "Medium")]
LOWEST_ENGAGEMENT = "Low"
QUALITY_TIERS = [(80, "High Quality"), (50, "Medium Quality")]
LOWEST_QUALITY_TIER = "Low Quality"
EXPANSION_TIERS = [(5, "Top Tier"), (15, "Mid Tier")]
LAST_EXPANSION_TIER = "Emerging"
SEVERITIES = [(3, "Critical"), (2, "High"), (1.5, "Medium")]
LOWEST_SEVERITY = "Low"


def _sum(points: list[Column]) -> Column:
    total = points[0]
    for more in points[1:]:
        total = total + more
    return total


def demographic_score() -> Column:
    return _sum(
        [F.when(F.col(name).isin(values), met).otherwise(unmet) for name, values, met, unmet in DEMOGRAPHIC_POINTS]
    )


def target_segment(score: Column) -> Column:
    return label_from(score, SEGMENTS, LOWEST_SEGMENT)


def engagement_score() -> Column:
    return _sum(
        [F.when(F.col(name) > bound, above).otherwise(below) for name, bound, above, below in ENGAGEMENT_POINTS]
    )


def engagement_tier(score: Column) -> Column:
    return label_from(score, ENGAGEMENT_TIERS, LOWEST_ENGAGEMENT)


def quality_tier(score: Column) -> Column:
    return label_from(score, QUALITY_TIERS, LOWEST_QUALITY_TIER)


def expansion_category(rank: Column) -> Column:
    return label_up_to(rank, EXPANSION_TIERS, LAST_EXPANSION_TIER)


def anomaly_severity(z_score: Column) -> Column:
    return label_above(z_score, SEVERITIES, LOWEST_SEVERITY)
