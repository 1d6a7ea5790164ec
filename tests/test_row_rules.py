from __future__ import annotations

import re
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from userlake.operators.users import enrich, users_transformed, validate_and_cleanse


def one(df, *columns):
    rows = df.select(*columns).collect()
    assert len(rows) == 1
    return tuple(rows[0])


GOOD = {"id": "7", "email": "a.b+c@x.co.uk", "phone": "(555) 123-4567"}


@pytest.mark.parametrize(
    ("change", "score", "issues"),
    [
        ({}, 100, []),
        ({"id": None}, 80, ["missing_id"]),
        ({"id": ""}, 80, ["missing_id"]),
        ({"email": None}, 85, ["invalid_email"]),
        ({"email": "a@b"}, 85, ["invalid_email"]),
        ({"email": "a@b.c"}, 85, ["invalid_email"]),
        ({"phone": None}, 90, ["invalid_phone"]),
        ({"phone": "123456789"}, 90, ["invalid_phone"]),
        ({"id": None, "phone": "1"}, 70, ["missing_id", "invalid_phone"]),
        ({"id": "", "email": "x", "phone": ""}, 55, ["missing_id", "invalid_email", "invalid_phone"]),
    ],
)
def test_score_and_issues(users_like, change, score, issues):
    judged = validate_and_cleanse(users_like({**GOOD, **change}))
    assert one(judged, "data_quality_score", "quality_issues") == (score, issues)


def test_issues_have_a_text_element_type(users_like):
    judged = validate_and_cleanse(users_like(GOOD))
    assert judged.schema["quality_issues"].dataType.simpleString() == "array<string>"
    assert judged.schema["data_quality_score"].dataType.simpleString() == "int"


def test_names(users_like):
    judged = validate_and_cleanse(users_like({"first_name": "  mary-ann ", "last_name": None}))
    assert one(judged, "first_name_clean", "last_name_clean", "full_name") == ("Mary-ann", None, "Mary-ann")


@pytest.mark.parametrize(
    ("email", "domain", "kind"),
    [
        ("a.b+c@x.co.uk", "x.co.uk", "Business"),
        ("me@gmail.com", "gmail.com", "Personal"),
        ("me@education.com", "education.com", "Educational"),
        ("me@mygov.org", "mygov.org", "Government"),
        ("nobody", "", "Business"),
        (None, None, "Business"),
    ],
)
def test_email(users_like, ctx, email, domain, kind):
    rich = enrich(validate_and_cleanse(users_like({"email": email})), ctx)
    assert one(rich, "email_domain", "email_provider_type") == (domain, kind)


@pytest.mark.parametrize(
    ("address", "expected"),
    [
        (None, (None, "Unknown", "Unknown", "Unknown")),
        ("1 Road", ("1 Road", "Unknown", "Unknown", "Unknown")),
        ("1 Road, Paris", ("1 Road", "Paris", "Unknown", "Unknown")),
        ("1 Road, Sydney, New South Wales, Australia", ("1 Road", "Sydney", "New South Wales", "South Wales")),
        ("1 Road, LA, California, United States", ("1 Road", "LA", "California", "Unknown")),
    ],
)
def test_address(users_like, ctx, address, expected):
    rich = enrich(validate_and_cleanse(users_like({"address": address})), ctx)
    assert one(rich, "street_address", "city", "state_country", "country") == expected


@pytest.mark.parametrize(
    ("phone", "formatted"),
    [("(555) 123-4567", "(555) 123-4567"), ("555.123.4567", "(555) 123-4567"),
     ("+44 123456789", "+44 123456789"), (None, None)],
)
def test_phone(users_like, ctx, phone, formatted):
    assert one(enrich(validate_and_cleanse(users_like({"phone": phone})), ctx), "phone_formatted") == (formatted,)


@pytest.mark.parametrize(
    ("dob", "expected"),
    [
        (None, (None, "65+", "Boomer")),
        ("not-a-date", (None, "65+", "Boomer")),
        ("2007-06-01T00:00:00.000Z", (17, "18-24", "Gen Z")),
        ("1999-12-31T10:00:00.000Z", (25, "25-34", "Gen Z")),
        ("1998-01-01T00:00:00.000Z", (27, "25-34", "Millennial")),
        ("1960-01-01T00:00:00.000Z", (65, "65+", "Boomer")),
    ],
)
def test_age(users_like, ctx, dob, expected):
    rich = enrich(validate_and_cleanse(users_like({"dob": dob})), ctx)
    assert one(rich, "age_years", "age_group", "generation") == expected


@pytest.mark.parametrize(
    ("registered", "days", "tenure"),
    [
        (None, None, "Veteran"),
        ("2024-12-31T00:00:00.000Z", 1, "New"),
        ("2024-12-02T00:00:00.000Z", 30, "Regular"),
        ("2024-01-02T00:00:00.000Z", 365, "Veteran"),
    ],
)
def test_tenure(users_like, ctx, registered, days, tenure):
    rich = enrich(validate_and_cleanse(users_like({"registered_date": registered})), ctx)
    assert one(rich, "account_age_days", "account_tenure_category") == (days, tenure)


def test_processing_date_defaults_to_the_run(users_like, ctx):
    users = users_transformed(users_like(GOOD), ctx)
    assert len(users.columns) == 31
    assert one(users, "processing_date", "glue_job_name") == (date(2025, 1, 1), "tests")


def test_no_row_is_dropped(users_like, ctx):
    assert users_transformed(users_like({}, {}, GOOD), ctx).count() == 3


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.none() | st.from_regex(r"[a-zA-Z0-9@. _%+-]{0,20}", fullmatch=True),
            st.none() | st.text("0123456789()+ -", max_size=16),
            st.none() | st.sampled_from(["", "1", "x"]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_rules_on_any_text(users_like, ctx, records):
    raw = users_like(*[{"email": e, "phone": p, "id": i, "username": str(n)} for n, (e, p, i) in enumerate(records)])
    rows = {int(r.username): r for r in users_transformed(raw, ctx).collect()}
    for n, (email, phone, user_id) in enumerate(records):
        good_email = bool(email) and bool(re.fullmatch(r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", email))
        good_phone = phone is not None and len(phone) >= 10
        score = 100 - (0 if user_id else 20) - (0 if good_email else 15) - (0 if good_phone else 10)
        digits = re.sub(r"\D", "", phone or "")
        shown = f"({digits[:3]}) {digits[3:6]}-{digits[6:]}" if len(digits) == 10 else phone
        row = rows[n]
        assert (row.email_valid, row.phone_valid, row.data_quality_score) == (good_email, good_phone, score)
        assert row.phone == shown
        assert len(row.quality_issues) == (not user_id) + (not good_email) + (not good_phone)
