from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from userlake.operators import facts, summaries, trends
from userlake.operators.anomalies import detect_anomalies
from userlake.operators.ranking import falling, rising, with_range_number, with_row_number
from userlake.operators.tallies import TOTAL, Kind, tallies
from userlake.operators.users import users_transformed
from userlake.plans.pairing import beside_every


def brute_row_numbers(rows, descending):
    """(group, order, name) -> place, by sorting each group whole."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    places = {}
    for members in groups.values():
        def key(row):
            name = row[2] or ""
            order = row[1]
            if descending:
                first = (0, 0) if order is None else (1, -order)
            else:
                first = (1, 0) if order is None else (0, order)
            return (*first, hashlib.md5(name.encode()).hexdigest(), name)

        for place, row in enumerate(sorted(members, key=key), start=1):
            places[row] = place
    return places


@pytest.mark.parametrize("descending", [True, False])
def test_row_number_equals_a_whole_sort(spark, descending):
    draw = random.Random(5)
    # Group "hot" holds most rows, and most of those share one order value.
    rows = [("hot", draw.choice([1, 1, 1, 1, 2, 9, None]), f"name{i}") for i in range(3000)]
    rows += [(draw.choice(["a", "b", None]), draw.randint(1, 5), f"other{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "grp string, n int, name string").repartition(7)
    numbered = with_row_number(df, "place", ["grp"], "n", ["name"], descending)
    assert numbered.columns == ["grp", "n", "name", "place"]
    got = {(r.grp, r.n, r.name): r.place for r in numbered.collect()}
    assert got == brute_row_numbers(rows, descending)


def test_row_number_keeps_duplicates(spark):
    df = spark.createDataFrame([("g", 1, "x")] * 3, "grp string, n int, name string")
    places = [r.place for r in with_row_number(df, "place", ["grp"], "n", ["name"]).collect()]
    assert sorted(places) == [1, 2, 3]


@pytest.mark.parametrize("ranges", [1, 8, 50])
def test_range_number_equals_a_whole_sort(spark, ranges):
    draw = random.Random(6)
    days = [None, *[date(2020, 1, 1) + timedelta(d) for d in range(40)]]
    # Group "hot" holds most rows, and most of those share one order value; the name settles ties.
    rows = [("hot", draw.choice([0.1, 0.1, 0.1, None, float(i)]), draw.choice(days), f"name{i}") for i in range(3000)]
    rows += [(draw.choice(["a", None]), draw.random(), draw.choice(days), f"other{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "grp string, x double, d date, name string").repartition(7)
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    for order, key in [
        ([*falling(F.col("x")), F.col("name")], lambda r: (r[1] is None, -(r[1] or 0), r[3])),
        ([*rising(F.col("d")), F.col("name")], lambda r: (r[2] is None, r[2] or date.min, r[3])),
    ]:
        numbered = with_range_number(df, "place", ["grp"], order, ranges)
        assert numbered.columns == ["grp", "x", "d", "name", "place"]
        want = {r: i for members in groups.values() for i, r in enumerate(sorted(members, key=key), 1)}
        assert {(r.grp, r.x, r.d, r.name): r.place for r in numbered.collect()} == want


def test_range_number_of_repeated_rows_and_of_none(spark):
    df = spark.createDataFrame([("g", 1)] * 5 + [("h", 2)], "grp string, n int")
    numbered = with_range_number(df, "place", ["grp"], [F.col("n")], 4)
    assert sorted((r.grp, r.place) for r in numbered.collect()) == [*[("g", i) for i in range(1, 6)], ("h", 1)]
    assert with_range_number(df.limit(0), "place", ["grp"], [F.col("n")]).count() == 0


def test_no_window_holds_the_countries_of_a_batch(tables):
    for name in ["fact_geographic_analysis", "fact_geographic_expansion", "vw_country_expansion_timeline"]:
        plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
        numbered = [line for line in plan.splitlines() if "row_number()" in line]
        assert numbered and all("_range" in line or "_cell" in line for line in numbered), name


def test_a_range_tells_later_ones_about_its_last_group_only(spark):
    """One group over many ranges: each row is numbered once, whatever the cut."""
    rows = [(i // 700, i) for i in range(2100)]
    df = spark.createDataFrame(rows, "grp int, n int")
    places = {(r.grp, r.n): r.place for r in with_range_number(df, "place", ["grp"], [F.col("n")], 16).collect()}
    assert places == {(g, n): n - 700 * g + 1 for g, n in rows}


def test_every_row_beside_every_other(spark):
    left = spark.createDataFrame([(i % 7, f"n{i % 40}") for i in range(60)], "a int, b string")
    right = spark.createDataFrame([(None,), (1,), (1,)], "c int")
    pairs = beside_every(left, right)
    assert pairs.columns == ["a", "b", "c"] and pairs.count() == 180
    assert Counter(r.c for r in pairs.collect()) == {None: 60, 1: 120}
    assert beside_every(left, right.limit(0)).count() == 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop", plan)


def test_tallies_equal_separate_counts(spark):
    draw = random.Random(7)
    rows = [(draw.choice(["x", "y", None, ""]), f"n{int(draw.expovariate(0.1))}") for _ in range(500)] + [(None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    kinds = [
        Kind("a", F.col("a")), Kind("filled", F.col("a"), where=F.col("a") != ""),
        Kind("top", F.col("b"), leading=True), Kind("names", F.col("b"), distinct=True),
    ]
    found = {(r.kind, r.value): (r.n, r["values"], r.total) for r in tallies(df, kinds, leaders=5).collect()}
    names = Counter(b for _, b in rows)
    assert {v: n for (k, v), (n, _, _) in found.items() if k == "a"} == Counter(a for a, _ in rows)
    assert {v: n for (k, v), (n, _, _) in found.items() if k == "filled"} == Counter(a for a, _ in rows if a)
    first = sorted(names.items(), key=lambda item: (-item[1], item[0] or ""))[:5]
    assert {v: n for (k, v), (n, _, _) in found.items() if k == "top"} == dict(first)
    assert found["names", None][:2] == (501, len([n for n in names if n]))
    assert found[TOTAL, None][0] == 501 and {total for _, _, total in found.values()} == {501}


def test_summaries_read_raw_users_once(spark, ctx, raw, tmp_path):
    raw.write.parquet(f"{tmp_path}/raw")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    for summary in [
        summaries.user_analytics, summaries.user_demographics, summaries.gender_distribution,
        summaries.email_domain_top10, summaries.country_distribution, summaries.state_distribution_top10,
        summaries.general_metrics,
    ]:
        plan = summary(stored, ctx)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Relation \[.*parquet", plan)) == 1, summary.__name__
    for union in [summaries.user_analytics, summaries.user_demographics]:
        assert "Sort [" not in union(stored, ctx)._jdf.queryExecution().optimizedPlan().toString()


def test_summaries_of_no_users(users_like, ctx):
    rows = [(r.metric_name, r.metric_value, r.percentage) for r in summaries.user_analytics(users_like(), ctx).collect()]
    assert sorted(rows) == [("total_users", 0, 100.0), ("unique_usernames", 0, None)]
    assert summaries.user_demographics(users_like(), ctx).count() == 0


def test_anomaly_detector_without_spread(spark):
    for values in ([5], [5, 5, 5]):
        df = spark.createDataFrame([(v,) for v in values], "x int")
        for row in detect_anomalies(df, "x").collect():
            assert (row.z_score, row.is_anomaly, row.anomaly_type, row.anomaly_severity) == (
                None, None, "Normal", "Low",
            )


def test_anomaly_detector_directions(spark):
    df = spark.createDataFrame([(10.0,)] * 30 + [(1000.0,), (-1000.0,)], "x double")
    marked = {r.x: (r.is_anomaly, r.anomaly_type, r.anomaly_severity) for r in detect_anomalies(df, "x").collect()}
    assert marked[1000.0] == (True, "High Anomaly", "Critical")
    assert marked[-1000.0] == (True, "Low Anomaly", "Critical")
    assert marked[10.0] == (False, "Normal", "Low")


def test_anomaly_detector_on_no_rows(spark):
    assert detect_anomalies(spark.createDataFrame([], "x int"), "x").count() == 0


def test_geographic_rows_cover_all_users(tables):
    geo = tables["fact_geographic_analysis"]
    totals = {r.analysis_type: r.n for r in geo.groupBy("analysis_type").agg(F.sum("user_count").alias("n")).collect()}
    assert totals == {"country": 150, "city": 150}
    ranks = geo.groupBy("analysis_type", "processing_date").agg(
        F.count("*").alias("n"), F.countDistinct("user_count_rank").alias("d"), F.max("user_count_rank").alias("m")
    )
    assert ranks.filter("n <> d OR n <> m").count() == 0
    later = geo.alias("a").join(geo.alias("b"), ["analysis_type", "processing_date"]).filter(
        "a.user_count_rank < b.user_count_rank AND a.user_count < b.user_count"
    )
    assert later.count() == 0


@pytest.mark.parametrize(
    ("name", "column"),
    [("fact_email_domain_analysis", "market_share_percentage"),
     ("fact_age_generation_analysis", "percentage_of_total"),
     ("fact_geographic_expansion", "market_share_percentage")],
)
def test_shares_of_a_batch_add_up(tables, name, column):
    for row in tables[name].groupBy("processing_date").agg(F.sum(column).alias("all"), F.count("*").alias("n")).collect():
        assert abs(row["all"] - 100) <= 0.005 * row.n + 1e-9


def test_quality_bands_partition_the_users(tables):
    row = tables["fact_data_quality_metrics"].first()
    bands = ["excellent_quality", "good_quality", "fair_quality", "poor_quality", "very_poor_quality"]
    assert sum(row[b] for b in bands) == row.total_records == 150
    assert row.very_poor_quality == 0
    for day in tables["fact_data_quality_trends"].collect():
        names = ["excellent_quality_count", "good_quality_count", "fair_quality_count", "poor_quality_count"]
        assert sum(day[n] for n in names) == day.total_records


def test_labels_that_no_score_reaches_are_absent(tables):
    assert tables["dim_user_demographics"].filter("target_segment = 'Basic'").isEmpty()
    assert tables["fact_age_generation_analysis"].filter("engagement_tier = 'Low'").isEmpty()


def test_users_without_registration_date_are_counted(users_like, ctx):
    users = users_transformed(
        users_like({"id": "1"}, {"id": "2", "registered_date": "2024-06-01T00:00:00.000Z"}), ctx
    )
    rows = trends.registration_trends(users, ctx).collect()
    got = sorted((r.period_type, r.time_period or "", r.registrations) for r in rows)
    # 2024-06-01 is a Saturday; a missing date is a row of its own, named like one.
    assert got == [
        ("day_of_week", "Saturday", 1), ("day_of_week", "Saturday", 1),
        ("monthly", "", 1), ("monthly", "2024-06", 1),
        ("quarterly", "", 1), ("quarterly", "2024-Q2", 1),
    ]
    expansion = trends.geographic_expansion(users, ctx).first()
    assert (expansion.user_count, expansion.days_since_first_user) == (2, 214)


def test_growth_of_one_batch_follows_one_sequence_of_each_kind(tables, ctx):
    """With one batch the growth is that of a sequence over all rows of a period kind."""
    users = tables["users_transformed"].withColumn("processing_date", F.lit(date(2024, 10, 1)))
    rows = trends.registration_trends(users, ctx).collect()
    for kind in trends.PERIOD_KINDS:
        mine = sorted((r for r in rows if r.period_type == kind), key=lambda r: (r.time_period or "", r.registrations))
        before = [None, *[r.registrations for r in mine[:-1]]]
        assert [r.previous_registrations for r in mine] == before
        assert mine[0].growth_rate is None
        for row, b in list(zip(mine, before))[1:]:
            assert abs(row.growth_rate - (row.registrations - b) * 100.0 / b) < 0.00501


def test_country_without_any_date_counts_from_today(users_like, ctx):
    row = trends.geographic_expansion(users_transformed(users_like({}, {}), ctx), ctx).first()
    assert (row.days_since_first_user, row.user_acquisition_rate) == (None, 2.0)


def test_empty_input_gives_one_row_of_totals(users_like, ctx):
    users = users_transformed(users_like(), ctx)
    row = facts.data_quality_metrics(users, ctx).first()
    assert (row.total_records, row.valid_emails, row.email_validity_percentage) == (0, None, None)
    assert facts.geographic_analysis(users, ctx).count() == 0
    general = {r.metric_name: r.metric_value for r in summaries.general_metrics(users_like(), ctx).collect()}
    assert general == {"total_users": 0, "unique_usernames": 0}


def test_gender_ratio_without_women_is_null(users_like, ctx):
    users = users_transformed(users_like({"gender": "male"}, {"gender": "male"}), ctx)
    row = facts.email_domain_analysis(users, ctx).first()
    assert (row.male_users, row.female_users, row.gender_ratio_male_female) == (2, 0, None)


def test_one_domain_holding_a_third_of_all_users(users_like, ctx):
    hot = [{"id": str(i), "email": f"u{i}@big.com", "gender": "male"} for i in range(400)]
    rest = [{"id": f"r{i}", "email": f"u{i}@d{i}.com", "gender": "female"} for i in range(800)]
    users = users_transformed(users_like(*hot, *rest), ctx)
    domains = {r.email_domain: r for r in facts.email_domain_analysis(users, ctx).collect()}
    assert len(domains) == 801
    assert (domains["big.com"].user_count, domains["big.com"].market_share_percentage) == (400, 33.33)
    assert domains["d0.com"].total_users_in_batch == 1200


def test_anomaly_detector_reads_its_input_twice(spark, tmp_path):
    path = f"{tmp_path}/numbers"
    spark.range(20).selectExpr("cast(id as double) AS x").write.parquet(path)
    marked = detect_anomalies(spark.read.parquet(path), "x")
    for df in (marked, marked.filter("is_anomaly"), marked.filter("is_anomaly AND anomaly_severity = 'High'")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
