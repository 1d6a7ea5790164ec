"""Row rules that judge and clean one raw user record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted e-mail form, the shortest phone text and the
# penalty and issue name of each rule.
EMAIL_FORM = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
SHORTEST_PHONE = 10
FULL_SCORE = 100
MISSING_ID = ("missing_id", 20)
INVALID_EMAIL = ("invalid_email", 15)
INVALID_PHONE = ("invalid_phone", 10)


def id_missing(user_id: Column) -> Column:
    return F.coalesce(user_id == "", F.lit(True))


def email_valid(email: Column) -> Column:
    return F.coalesce(email.rlike(EMAIL_FORM), F.lit(False))


def phone_valid(phone: Column) -> Column:
    """Length of the raw text, punctuation included."""
    return F.coalesce(F.length(phone) >= SHORTEST_PHONE, F.lit(False))


def _violations() -> list[tuple[Column, str, int]]:
    return [
        (F.col("id_missing"), *MISSING_ID),
        (~F.col("email_valid"), *INVALID_EMAIL),
        (~F.col("phone_valid"), *INVALID_PHONE),
    ]


def quality_score() -> Column:
    """100 less the penalty of every rule the record breaks."""
    score = F.lit(FULL_SCORE)
    for broken, _, penalty in _violations():
        score = score - F.when(broken, penalty).otherwise(0)
    return score


def quality_issues() -> Column:
    """Names of the broken rules, in rule order; an empty array for a clean record."""
    none = F.array().cast("array<string>")
    return F.concat(
        *[F.when(broken, F.array(F.lit(issue))).otherwise(none) for broken, issue, _ in _violations()]
    )


def clean_name(name: Column) -> Column:
    return F.initcap(F.trim(name))
