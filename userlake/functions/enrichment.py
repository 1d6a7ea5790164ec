"""Attributes derived from one cleansed user record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from userlake.functions.measures import label_below

# Source time format, length of a year, age and generation bounds,
# provider lists, address and country patterns, tenure bounds.
SOURCE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DAYS_PER_YEAR = 365.25
AGE_GROUPS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
OLDEST_AGE_GROUP = "65+"
GENERATIONS = [(27, "Gen Z"), (43, "Millennial"), (59, "Gen X")]
OLDEST_GENERATION = "Boomer"
DOMAIN_OF_EMAIL = r"@([^.]+\..*)"
PERSONAL_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com"]
UNKNOWN = "Unknown"
COUNTRY_TAIL = r"\s+([A-Za-z\s]+)$"
TENURES = [(30, "New"), (365, "Regular")]
LONGEST_TENURE = "Veteran"


def source_date(text: Column) -> Column:
    """Date of an ISO time text; null where the text is not one."""
    return F.to_date(F.try_to_timestamp(text, F.lit(SOURCE_TIME)))


def age_years(birth_date: Column, today: Column) -> Column:
    return F.floor(F.datediff(today, birth_date) / F.lit(DAYS_PER_YEAR)).cast("int")


def age_group(age: Column) -> Column:
    return label_below(age, AGE_GROUPS, OLDEST_AGE_GROUP)


def generation(age: Column) -> Column:
    return label_below(age, GENERATIONS, OLDEST_GENERATION)


def email_domain(email: Column) -> Column:
    return F.regexp_extract(email, DOMAIN_OF_EMAIL, 1)


def email_provider_type(domain: Column) -> Column:
    return (
        F.when(domain.isin(PERSONAL_DOMAINS), "Personal")
        .when(domain.contains("edu"), "Educational")
        .when(domain.contains("gov"), "Government")
        .otherwise("Business")
    )


def address_part(parts: Column, position: int) -> Column:
    return F.trim(F.get(parts, F.lit(position)))


def address_part_or_unknown(parts: Column, position: int) -> Column:
    return F.coalesce(address_part(parts, position), F.lit(UNKNOWN))


def country_of_state(state_country: Column) -> Column:
    """Trailing words of the third address part, which is the rule of the cleaned table."""
    tail = F.regexp_extract(state_country, COUNTRY_TAIL, 1)
    return F.when(tail == "", UNKNOWN).otherwise(tail)


def phone_digits(phone: Column) -> Column:
    return F.regexp_replace(phone, r"[^\d]", "")


def phone_formatted(phone: Column, digits: Column) -> Column:
    pretty = F.concat(
        F.lit("("), F.substring(digits, 1, 3), F.lit(") "),
        F.substring(digits, 4, 3), F.lit("-"), F.substring(digits, 7, 4),
    )
    return F.when(F.length(digits) == 10, pretty).otherwise(phone)


def account_tenure(age_days: Column) -> Column:
    return label_below(age_days, TENURES, LONGEST_TENURE)
