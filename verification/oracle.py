"""The same queries as SQL for DuckDB, written from the definitions of the results.

Each statement is a WITH chain over the given tables. Layers of the chain are
kept by name, and a statement takes the ones its text mentions.
"""

from __future__ import annotations

import re

from userlake.sources.fixture import USER_EXPRESSIONS
from userlake.sources.records import RAW_COLUMNS

from verification.queries import ORDER_DEPENDENT

TODAY = "DATE '2025-01-01'"
TODAY_TEXT = "'2025-01-01'"
NOW = "'2025-01-01 00:00:00'"
NOW_ISO = "'2025-01-01T00:00:00'"
RAW12 = ", ".join(RAW_COLUMNS)
RAW13 = f"{RAW12}, processing_date"


def rnd(value: str, digits: int) -> str:
    """Half away from zero on the decimal value, as Spark rounds."""
    return f"CAST(round(CAST({value} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return rnd(f"({part}) * 100e0 / nullif({whole}, 0)", 2)


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def num(value: str) -> str:
    return f"CAST({value} AS INTEGER)"


def cnt(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def text(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def day(value: str) -> str:
    return f"CAST({value} AS DATE)"


def initcap(value: str) -> str:
    return f"upper(left(trim({value}), 1)) || lower(substr(trim({value}), 2))"


def iso_date(value: str) -> str:
    return f"CAST(try_strptime({value}, '%Y-%m-%dT%H:%M:%S.%gZ') AS DATE)"


AGE_LADDER = (
    "CASE WHEN {0} < 25 THEN '18-24' WHEN {0} < 35 THEN '25-34' WHEN {0} < 45 THEN '35-44'"
    " WHEN {0} < 55 THEN '45-54' WHEN {0} < 65 THEN '55-64' ELSE '65+' END"
)
QUALITY_LADDER = (
    "CASE WHEN data_quality_score >= 80 THEN 'High Quality'"
    " WHEN data_quality_score >= 50 THEN 'Medium Quality' ELSE 'Low Quality' END"
)
SEVERITY_LADDER = (
    "CASE WHEN z_score > 3 THEN 'Critical' WHEN z_score > 2 THEN 'High'"
    " WHEN z_score > 1.5 THEN 'Medium' ELSE 'Low' END"
)

# ---------------------------------------------------------------- layers

LAYERS: dict[str, str] = {}

LAYERS["raw"] = (
    "SELECT * REPLACE (CAST(processing_date AS VARCHAR) AS processing_date) FROM (SELECT "
    + ", ".join(f"{expression} AS {name}" for name, expression in USER_EXPRESSIONS.items())
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)
LAYERS["judged"] = f"""
SELECT *, id IS NULL OR id = '' AS bad_id,
  coalesce(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$'), false) AS email_valid,
  coalesce(length(phone) >= 10, false) AS phone_valid,
  {initcap('first_name')} AS first_name_clean, {initcap('last_name')} AS last_name_clean,
  string_split(address, ',') AS parts, {iso_date('dob')} AS birth_date,
  {iso_date('registered_date')} AS registration_date,
  regexp_extract(email, '@([^.]+\\..*)', 1) AS email_domain,
  regexp_replace(phone, '[^0-9]', '', 'g') AS phone_clean
FROM raw"""
LAYERS["scored"] = f"""
SELECT *, concat_ws(' ', first_name_clean, last_name_clean) AS full_name,
  {num("100 - CASE WHEN bad_id THEN 20 ELSE 0 END - CASE WHEN email_valid THEN 0 ELSE 15 END"
       " - CASE WHEN phone_valid THEN 0 ELSE 10 END")} AS data_quality_score,
  concat_ws('|', CASE WHEN bad_id THEN 'missing_id' END, CASE WHEN NOT email_valid THEN 'invalid_email' END,
            CASE WHEN NOT phone_valid THEN 'invalid_phone' END) AS quality_issues,
  trim(parts[1]) AS street_address, coalesce(trim(parts[2]), 'Unknown') AS city,
  coalesce(trim(parts[3]), 'Unknown') AS state_country,
  {num(f"floor(date_diff('day', birth_date, {TODAY}) / 365.25e0)")} AS age_years,
  {num(f"date_diff('day', registration_date, {TODAY})")} AS account_age_days,
  CASE WHEN length(phone_clean) = 10
       THEN '(' || substr(phone_clean, 1, 3) || ') ' || substr(phone_clean, 4, 3) || '-' || substr(phone_clean, 7, 4)
       ELSE phone END AS phone_formatted,
  CASE WHEN email_domain IN ('gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com') THEN 'Personal'
       WHEN contains(email_domain, 'edu') THEN 'Educational'
       WHEN contains(email_domain, 'gov') THEN 'Government' ELSE 'Business' END AS email_provider_type
FROM judged"""
LAYERS["rich"] = f"""
SELECT *, {AGE_LADDER.format('age_years')} AS age_group,
  CASE WHEN age_years < 27 THEN 'Gen Z' WHEN age_years < 43 THEN 'Millennial'
       WHEN age_years < 59 THEN 'Gen X' ELSE 'Boomer' END AS generation,
  coalesce(nullif(regexp_extract(state_country, '\\s+([A-Za-z\\s]+)$', 1), ''), 'Unknown') AS country,
  CASE WHEN account_age_days < 30 THEN 'New' WHEN account_age_days < 365 THEN 'Regular'
       ELSE 'Veteran' END AS account_tenure_category,
  {NOW} AS processed_at, 'randomuser_api' AS data_source, 'userlake' AS glue_job_name
FROM scored"""
LAYERS["u"] = f"""
SELECT id, first_name_clean AS first_name, last_name_clean AS last_name, full_name, gender, email, email_domain,
  email_provider_type, email_valid, username, phone_formatted AS phone, phone_valid, address, street_address,
  city, country, post_code, {text('birth_date')} AS birth_date, age_years, age_group, generation,
  {text('registration_date')} AS registration_date, account_age_days, account_tenure_category, data_quality_score, quality_issues, picture, processed_at, processing_date,
  data_source, glue_job_name
FROM rich"""

# --- ingest summaries

LAYERS["located"] = (
    "SELECT *, trim(string_split(address, ',')[4]) AS country, trim(string_split(address, ',')[3]) AS state FROM raw"
)
LAYERS["genders"] = f"""
SELECT 'gender_distribution' AS metric_type, 'gender_' || gender AS metric_name, count(*) AS metric_value,
  {pct('count(*)', '(SELECT count(*) FROM raw)')} AS percentage, {NOW_ISO} AS created_at
FROM raw GROUP BY gender"""
LAYERS["domains10"] = f"""
SELECT 'email_domain_distribution' AS metric_type, 'domain_' || d AS metric_name, n AS metric_value,
  {pct('n', '(SELECT count(*) FROM raw)')} AS percentage, {NOW_ISO} AS created_at
FROM (SELECT string_split(email, '@')[2] AS d, count(*) AS n FROM raw GROUP BY 1)
ORDER BY n DESC, d NULLS FIRST LIMIT 10"""
LAYERS["generals"] = f"""
SELECT 'general' AS metric_type, 'total_users' AS metric_name, count(*) AS metric_value,
  100e0 AS percentage, {NOW_ISO} AS created_at FROM raw
UNION ALL
SELECT 'general', 'unique_usernames', count(DISTINCT username), {pct('count(DISTINCT username)', 'count(*)')}, {NOW_ISO}
FROM raw"""
LAYERS["metrics"] = (
    "SELECT * FROM genders UNION ALL SELECT * FROM domains10 UNION ALL SELECT * FROM generals"
)


def _places(level: str) -> str:
    return f"""
SELECT '{level}_distribution' AS demographic_type, {level} AS demographic_value, count(*) AS user_count,
  {pct('count(*)', '(SELECT count(*) FROM raw)')} AS percentage, {NOW_ISO} AS created_at
FROM located WHERE {level} <> '' GROUP BY {level}"""


LAYERS["countries_raw"] = _places("country")
LAYERS["states10"] = _places("state") + " ORDER BY user_count DESC, demographic_value LIMIT 10"
LAYERS["places"] = "SELECT * FROM countries_raw UNION ALL SELECT * FROM states10"

# --- dimension and facts

LAYERS["dim"] = f"""
SELECT *, CASE WHEN demographic_score >= 40 THEN 'Premium' WHEN demographic_score >= 25 THEN 'Standard'
               ELSE 'Basic' END AS target_segment,
  {NOW} AS dim_created_at, {NOW} AS dim_updated_at, true AS is_current
FROM (SELECT *, CASE WHEN age_group IN ('25-34', '35-44') THEN 10 ELSE 5 END
             + CASE WHEN generation IN ('Millennial', 'Gen X') THEN 10 ELSE 5 END
             + CASE WHEN email_provider_type = 'Business' THEN 15 ELSE 5 END
             + CASE WHEN account_tenure_category = 'Veteran' THEN 20 ELSE 10 END AS demographic_score
      FROM (SELECT DISTINCT id AS user_id, age_group, generation, gender, country, city, email_provider_type,
              account_tenure_category, data_quality_score, processing_date FROM u))"""


def _geo(keys: str, level: str, kind: str) -> str:
    return f"""
SELECT {level} AS geographic_level, '{kind}' AS analysis_type, count(*) AS user_count,
  count(DISTINCT email_domain) AS unique_email_domains, avg(age_years) AS avg_age,
  avg(data_quality_score) AS avg_data_quality,
  {pct(cnt("gender = 'male'"), 'count(*)')} AS male_percentage,
  {pct(cnt("gender = 'female'"), 'count(*)')} AS female_percentage,
  {pct(cnt("email_provider_type = 'Business'"), 'count(*)')} AS business_email_percentage, processing_date
FROM u GROUP BY {keys}, processing_date"""


LAYERS["geo_country"] = _geo("country", "country", "country")
LAYERS["geo_city"] = _geo("city, country", "concat_ws(', ', city, country)", "city")
LAYERS["geo"] = f"""
SELECT *, {num("row_number() OVER (PARTITION BY processing_date ORDER BY user_count DESC, geographic_level)")}
  AS user_count_rank, {NOW} AS created_at FROM geo_country
UNION ALL
SELECT *, {num("row_number() OVER (PARTITION BY processing_date"
               " ORDER BY user_count DESC, md5(geographic_level), geographic_level)")}, {NOW} FROM geo_city"""
LAYERS["agegen"] = f"""
SELECT *, CASE WHEN engagement_score >= 35 THEN 'High' WHEN engagement_score >= 20 THEN 'Medium'
               ELSE 'Low' END AS engagement_tier, {NOW} AS created_at
FROM (SELECT *, CASE WHEN avg_account_age_days > 365 THEN 20 ELSE 10 END
             + CASE WHEN business_email_percentage > 50 THEN 15 ELSE 5 END
             + CASE WHEN avg_data_quality > 80 THEN 10 ELSE 5 END
             + CASE WHEN countries_represented > 1 THEN 5 ELSE 0 END AS engagement_score
  FROM (SELECT *, {pct('user_count', 'total_users_in_batch')} AS percentage_of_total,
      {pct('business_email_count', 'user_count')} AS business_email_percentage,
      {pct('veteran_users', 'user_count')} AS veteran_percentage
    FROM (SELECT age_group, generation, gender, processing_date, count(*) AS user_count,
        avg(data_quality_score) AS avg_data_quality, avg(account_age_days) AS avg_account_age_days,
        count(DISTINCT country) AS countries_represented, count(DISTINCT email_domain) AS unique_email_domains,
        {cnt("email_provider_type = 'Personal'")} AS personal_email_count,
        {cnt("email_provider_type = 'Business'")} AS business_email_count,
        {cnt("account_tenure_category = 'Veteran'")} AS veteran_users,
        {cnt("account_tenure_category = 'New'")} AS new_users,
        {big('sum(count(*)) OVER (PARTITION BY processing_date)')} AS total_users_in_batch
      FROM u GROUP BY age_group, generation, gender, processing_date)))"""
LAYERS["domains"] = f"""
SELECT *, {pct('user_count', 'total_users_in_batch')} AS market_share_percentage,
  CASE WHEN female_users > 0 THEN {rnd('CAST(male_users AS DOUBLE) / nullif(female_users, 0)', 2)} END
    AS gender_ratio_male_female,
  'domain' AS analysis_level, {NOW} AS created_at
FROM (SELECT email_domain, email_provider_type, processing_date, count(*) AS user_count,
    count(DISTINCT country) AS countries_using, avg(age_years) AS avg_user_age,
    avg(data_quality_score) AS avg_data_quality, {cnt("gender = 'male'")} AS male_users,
    {cnt("gender = 'female'")} AS female_users,
    {big('sum(count(*)) OVER (PARTITION BY processing_date)')} AS total_users_in_batch
  FROM u GROUP BY email_domain, email_provider_type, processing_date)"""
LAYERS["providers"] = f"""
SELECT email_provider_type, processing_date, count(*) AS total_users, count(DISTINCT email_domain) AS unique_domains,
  avg(age_years) AS avg_age, avg(data_quality_score) AS avg_data_quality,
  count(DISTINCT country) AS countries_represented, 'provider_type' AS analysis_level, {NOW} AS created_at
FROM u GROUP BY email_provider_type, processing_date"""
LAYERS["dq"] = f"""
SELECT *, {TODAY_TEXT} AS processing_date, {pct('excellent_quality', 'total_records')} AS excellent_quality_percentage,
  {pct('good_quality', 'total_records')} AS good_quality_percentage,
  {pct('valid_emails', 'total_records')} AS email_validity_percentage,
  {pct('valid_phones', 'total_records')} AS phone_validity_percentage,
  {pct('valid_emails + valid_phones', 'total_records * 2')} AS data_completeness_score, {NOW} AS created_at
FROM (SELECT count(*) AS total_records, {cnt('data_quality_score >= 90')} AS excellent_quality,
    {cnt('data_quality_score BETWEEN 80 AND 89')} AS good_quality,
    {cnt('data_quality_score BETWEEN 70 AND 79')} AS fair_quality,
    {cnt('data_quality_score BETWEEN 50 AND 69')} AS poor_quality,
    {cnt('data_quality_score < 50')} AS very_poor_quality,
    avg(data_quality_score) AS avg_quality_score, min(data_quality_score) AS min_quality_score,
    max(data_quality_score) AS max_quality_score, {cnt('email_valid')} AS valid_emails,
    {cnt('phone_valid')} AS valid_phones, count(DISTINCT id) AS unique_users,
    {cnt("quality_issues <> ''")} AS records_with_issues FROM u)"""
LAYERS["segments"] = f"""
SELECT *, {pct('valid_emails_in_segment', 'segment_total')} AS segment_email_validity_rate,
  {pct('valid_phones_in_segment', 'segment_total')} AS segment_phone_validity_rate, {NOW} AS created_at
FROM (SELECT age_group, generation, processing_date, count(*) AS segment_total,
    avg(data_quality_score) AS avg_segment_quality, {cnt('email_valid')} AS valid_emails_in_segment,
    {cnt('phone_valid')} AS valid_phones_in_segment
  FROM u GROUP BY age_group, generation, processing_date)"""

# --- trends

LAYERS["calendar"] = f"""
SELECT *, {num(f"year({day('registration_date')})")} AS registration_year,
  {num(f"month({day('registration_date')})")} AS registration_month,
  {num(f"quarter({day('registration_date')})")} AS registration_quarter,
  {num(f"dayofweek({day('registration_date')}) + 1")} AS registration_day_of_week,
  dayname({day('registration_date')}) AS registration_day_name
FROM u"""


def _period(key: str, kind: str) -> str:
    return f"""
SELECT {key} AS time_period, '{kind}' AS period_type, count(*) AS registrations,
  count(DISTINCT country) AS countries_represented, avg(age_years) AS avg_age_at_registration,
  {pct(cnt("gender = 'male'"), 'count(*)')} AS male_percentage,
  {pct(cnt("gender = 'female'"), 'count(*)')} AS female_percentage,
  avg(data_quality_score) AS avg_data_quality, processing_date
FROM calendar GROUP BY {key}, processing_date"""


LAYERS["months"] = _period(
    "CAST(registration_year AS VARCHAR) || '-' || lpad(CAST(registration_month AS VARCHAR), 2, '0')", "monthly"
)
LAYERS["quarters"] = _period(
    "CAST(registration_year AS VARCHAR) || '-Q' || CAST(registration_quarter AS VARCHAR)", "quarterly"
)
LAYERS["weekdays"] = f"""
SELECT registration_day_name AS time_period, 'day_of_week' AS period_type, count(*) AS registrations,
  {big('0')} AS countries_represented, avg(age_years) AS avg_age_at_registration, 0e0 AS male_percentage,
  0e0 AS female_percentage, avg(data_quality_score) AS avg_data_quality, processing_date
FROM calendar GROUP BY registration_day_name, processing_date"""
LAYERS["regs"] = f"""
SELECT *, CASE WHEN previous_registrations > 0
               THEN {pct('registrations - previous_registrations', 'previous_registrations')} END AS growth_rate,
  {NOW} AS created_at
FROM (SELECT *, lag(registrations) OVER (PARTITION BY period_type, processing_date ORDER BY time_period)
        AS previous_registrations
      FROM (SELECT * FROM months UNION ALL SELECT * FROM quarters UNION ALL SELECT * FROM weekdays))"""
LAYERS["expansion"] = f"""
SELECT *, CASE WHEN user_count_rank <= 5 THEN 'Top Tier' WHEN user_count_rank <= 15 THEN 'Mid Tier'
               ELSE 'Emerging' END AS expansion_category, {NOW} AS created_at
FROM (SELECT *, {pct('user_count', 'total_users_global')} AS market_share_percentage,
    {num('row_number() OVER (PARTITION BY processing_date ORDER BY user_count DESC, country)')} AS user_count_rank,
    {num('row_number() OVER (PARTITION BY processing_date ORDER BY user_acquisition_rate DESC, country)')}
      AS expansion_rate_rank
  FROM (SELECT *, {rnd('CAST(user_count AS DOUBLE) / greatest(days_since_first_user, 1)', 4)} AS user_acquisition_rate,
      {big('sum(user_count) OVER (PARTITION BY processing_date)')} AS total_users_global
    FROM (SELECT country, processing_date, count(*) AS user_count, min(registration_date) AS first_user_date,
        max(registration_date) AS latest_user_date, count(DISTINCT city) AS cities_represented,
        avg(age_years) AS avg_user_age, avg(data_quality_score) AS avg_data_quality,
        {num(f"date_diff('day', {day('min(registration_date)')}, {TODAY})")} AS days_since_first_user
      FROM u GROUP BY country, processing_date)))"""
LAYERS["agedays"] = f"""
SELECT age_group, generation, registration_date, processing_date, count(*) AS user_count,
  avg(data_quality_score) AS avg_data_quality, count(DISTINCT country) AS countries_represented,
  {num(f"year({day('registration_date')})")} AS registration_year
FROM u GROUP BY age_group, generation, registration_date, processing_date"""
LAYERS["ages"] = f"""
SELECT *, CASE WHEN previous_year_percentage IS NULL THEN 'New'
               WHEN percentage_of_year > previous_year_percentage THEN 'Growing'
               WHEN percentage_of_year < previous_year_percentage THEN 'Declining' ELSE 'Stable' END AS trend_direction,
  coalesce(abs(percentage_of_year - previous_year_percentage), 0e0) AS trend_magnitude, {NOW} AS created_at
FROM (SELECT *, lag(percentage_of_year) OVER (PARTITION BY age_group, processing_date
                                              ORDER BY registration_year, generation) AS previous_year_percentage
  FROM (SELECT *, {pct('total_users_in_group', 'total_users_in_year')} AS percentage_of_year
    FROM (SELECT *, {big('sum(total_users_in_group) OVER (PARTITION BY registration_year, processing_date)')}
            AS total_users_in_year
      FROM (SELECT age_group, generation, registration_year, processing_date,
          {big('sum(user_count)')} AS total_users_in_group, avg(avg_data_quality) AS avg_data_quality,
          {big('sum(countries_represented)')} AS total_countries
        FROM agedays GROUP BY age_group, generation, registration_year, processing_date))))"""
LAYERS["qtrend"] = f"""
SELECT *, CASE WHEN previous_avg_quality IS NULL THEN 'Baseline'
               WHEN avg_quality_score > previous_avg_quality + 1 THEN 'Improving'
               WHEN avg_quality_score < previous_avg_quality - 1 THEN 'Declining' ELSE 'Stable' END AS quality_trend,
  coalesce({rnd('avg_quality_score - previous_avg_quality', 2)}, 0e0) AS quality_change, {NOW} AS created_at
FROM (SELECT *, lag(avg_quality_score) OVER (ORDER BY processing_date) AS previous_avg_quality
  FROM (SELECT processing_date, count(*) AS total_records, avg(data_quality_score) AS avg_quality_score,
      {cnt('data_quality_score >= 90')} AS excellent_quality_count,
      {cnt('data_quality_score BETWEEN 80 AND 89')} AS good_quality_count,
      {cnt('data_quality_score BETWEEN 70 AND 79')} AS fair_quality_count,
      {cnt('data_quality_score < 70')} AS poor_quality_count,
      {cnt('email_valid')} AS valid_emails, {cnt('phone_valid')} AS valid_phones,
      {pct(cnt('data_quality_score >= 90'), 'count(*)')} AS excellent_quality_percentage,
      {pct(cnt('data_quality_score BETWEEN 80 AND 89'), 'count(*)')} AS good_quality_percentage,
      {pct(cnt('email_valid'), 'count(*)')} AS email_validity_percentage,
      {pct(cnt('phone_valid'), 'count(*)')} AS phone_validity_percentage
    FROM u GROUP BY processing_date))"""


def _marked(source: str, metric: str, threshold: str = "2") -> str:
    return f"""
SELECT * EXCLUDE (mean), z_score > {threshold} AS is_anomaly,
  CASE WHEN z_score > {threshold} AND {metric} > mean THEN 'High Anomaly'
       WHEN z_score > {threshold} AND {metric} < mean THEN 'Low Anomaly' ELSE 'Normal' END AS anomaly_type,
  {SEVERITY_LADDER} AS anomaly_severity
FROM (SELECT s.*, mean, abs({metric} - mean) / spread AS z_score
      FROM {source} s, (SELECT avg({metric}) AS mean, stddev_samp({metric}) AS spread FROM {source}))"""


LAYERS["monthly_rows"] = "SELECT * FROM regs WHERE period_type = 'monthly'"
LAYERS["reg_odd"] = _marked("monthly_rows", "registrations")
LAYERS["q_odd"] = _marked("qtrend", "avg_quality_score")

# --- views that other statements read

LAYERS["v_agegen"] = f"""
SELECT age_group, generation, count(*) AS user_count,
  {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage FROM u GROUP BY ALL"""
LAYERS["v_tiers"] = (
    f"SELECT {QUALITY_LADDER} AS quality_tier, count(*) AS count, avg(data_quality_score) AS avg_score FROM u GROUP BY 1"
)
LAYERS["v_segments"] = f"""
SELECT target_segment, count(*) AS user_count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage,
  avg(data_quality_score) AS avg_quality_score FROM dim GROUP BY target_segment"""
LAYERS["v_countries"] = """
SELECT geographic_level AS country, user_count, avg_age, male_percentage, female_percentage,
  business_email_percentage, user_count_rank, processing_date FROM geo WHERE analysis_type = 'country'"""
LAYERS["v_diversity"] = f"""
SELECT analysis_type, count(*) AS total_locations, {big('sum(user_count)')} AS total_users,
  avg(avg_age) AS global_avg_age, avg(business_email_percentage) AS avg_business_email_pct
FROM geo GROUP BY analysis_type"""
LAYERS["v_cities"] = """
SELECT geographic_level, user_count, business_email_percentage, avg_data_quality
FROM geo WHERE analysis_type = 'city' AND user_count >= 5"""
LAYERS["v_engagement"] = """
SELECT generation, engagement_tier, count(*) AS segment_count, avg(avg_account_age_days) AS avg_account_age,
  avg(business_email_percentage) AS avg_business_email_pct, avg(veteran_percentage) AS avg_veteran_pct
FROM agegen GROUP BY generation, engagement_tier"""
LAYERS["v_gender"] = f"""
SELECT age_group, gender, {big('sum(user_count)')} AS total_users, avg(avg_data_quality) AS avg_quality,
  avg(countries_represented) AS avg_countries_represented FROM agegen GROUP BY age_group, gender"""
LAYERS["v_share"] = f"""
SELECT email_provider_type, total_users, unique_domains,
  {pct('total_users', 'sum(total_users) OVER ()')} AS market_share_pct, avg_age, countries_represented
FROM providers"""
LAYERS["v_provider_age"] = f"""
SELECT email_provider_type, {rnd('avg(avg_user_age)', 1)} AS avg_age, count(DISTINCT email_domain) AS unique_domains,
  {big('sum(user_count)')} AS total_users, {rnd('avg(gender_ratio_male_female)', 2)} AS avg_gender_ratio
FROM domains GROUP BY email_provider_type"""
LAYERS["v_batches"] = """
SELECT CASE WHEN excellent_quality_percentage >= 50 THEN 'Excellent Batch'
            WHEN good_quality_percentage + excellent_quality_percentage >= 70 THEN 'Good Batch'
            ELSE 'Needs Improvement' END AS batch_quality_tier,
  count(*) AS batch_count, avg(avg_quality_score) AS avg_score, avg(data_completeness_score) AS avg_completeness
FROM dq GROUP BY 1"""
LAYERS["v_complete"] = f"""
SELECT 'Bronze Layer' AS layer, count(*) AS record_count, count(email) AS emails_present,
  count(phone) AS phones_present, {big('NULL')} AS emails_valid, {big('NULL')} AS phones_valid FROM raw
UNION ALL
SELECT 'Silver Layer', count(*), NULL, NULL, {cnt('email_valid')}, {cnt('phone_valid')} FROM u"""
LAYERS["v_summary"] = f"""
SELECT (SELECT count(*) FROM u) AS total_users,
  (SELECT count(DISTINCT target_segment) FROM dim) AS target_segments,
  (SELECT count(DISTINCT analysis_type) FROM geo) AS geographic_levels,
  (SELECT {rnd('avg(avg_quality_score)', 2)} FROM dq) AS overall_quality_score,
  (SELECT count(*) FROM providers) AS email_provider_types, {NOW} AS report_generated_at"""
LAYERS["v_months"] = f"""
SELECT time_period, registrations, countries_represented,
  {rnd('avg_age_at_registration', 1)} AS avg_age_at_registration, male_percentage, female_percentage,
  {rnd('avg_data_quality', 1)} AS avg_data_quality, growth_rate,
  CASE WHEN growth_rate > 20 THEN 'High Growth' WHEN growth_rate > 0 THEN 'Growing'
       WHEN growth_rate < -10 THEN 'Declining' ELSE 'Stable' END AS growth_category, processing_date
FROM monthly_rows"""
LAYERS["v_quarters"] = f"""
SELECT *, CASE WHEN performance_rank <= 2 THEN 'Top Performer' WHEN performance_rank <= 4 THEN 'Good Performer'
               ELSE 'Needs Improvement' END AS performance_tier
FROM (SELECT time_period, registrations, countries_represented,
        {rnd('avg_age_at_registration', 1)} AS avg_age_at_registration, growth_rate,
        {num('rank() OVER (ORDER BY registrations DESC)')} AS performance_rank, processing_date
      FROM regs WHERE period_type = 'quarterly')"""
LAYERS["v_days"] = f"""
SELECT time_period AS day_name, registrations, {rnd('avg_age_at_registration', 1)} AS avg_age_at_registration,
  {rnd('avg_data_quality', 1)} AS avg_data_quality,
  {num('rank() OVER (ORDER BY registrations DESC)')} AS popularity_rank,
  {pct('registrations', 'sum(registrations) OVER ()')} AS percentage_of_weekly_registrations, processing_date
FROM regs WHERE period_type = 'day_of_week'"""
LAYERS["v_growing"] = f"""
SELECT country, user_count, user_acquisition_rate, market_share_percentage, expansion_category, cities_represented,
  {rnd('avg_user_age', 1)} AS avg_user_age, {rnd('avg_data_quality', 1)} AS avg_data_quality,
  days_since_first_user, first_user_date, user_count_rank, expansion_rate_rank, processing_date
FROM expansion WHERE expansion_category IN ('Top Tier', 'Mid Tier')"""
LAYERS["v_penetration"] = f"""
SELECT expansion_category, processing_date, count(*) AS country_count, {big('sum(user_count)')} AS total_users,
  {rnd('avg(market_share_percentage)', 2)} AS avg_market_share,
  {rnd('avg(user_acquisition_rate)', 4)} AS avg_acquisition_rate,
  {rnd('avg(cities_represented)', 1)} AS avg_cities_per_country,
  min(first_user_date) AS earliest_expansion_date, max(first_user_date) AS latest_expansion_date
FROM expansion GROUP BY expansion_category, processing_date"""
LAYERS["v_timeline"] = f"""
SELECT country, first_user_date, user_count, user_acquisition_rate, expansion_category,
  {num(f"year({day('first_user_date')})")} AS expansion_year,
  {num(f"month({day('first_user_date')})")} AS expansion_month,
  {num('row_number() OVER (PARTITION BY left(first_user_date, 4) ORDER BY first_user_date, country, processing_date)')}
    AS country_rank_in_year, processing_date
FROM expansion"""
LAYERS["v_ages"] = f"""
SELECT age_group, generation, registration_year, total_users_in_group, percentage_of_year, trend_direction,
  {rnd('trend_magnitude', 2)} AS trend_magnitude,
  CASE WHEN trend_direction = 'Growing' AND trend_magnitude > 5 THEN 'Rapidly Growing'
       WHEN trend_direction = 'Declining' AND trend_magnitude > 5 THEN 'Rapidly Declining'
       ELSE trend_direction END AS trend_intensity,
  {rnd('avg_data_quality', 1)} AS avg_data_quality, total_countries, processing_date
FROM ages"""
LAYERS["v_generations"] = f"""
SELECT generation, registration_year, processing_date, {big('sum(total_users_in_group)')} AS total_generation_users,
  {rnd('avg(percentage_of_year)', 2)} AS avg_percentage_of_year,
  count(DISTINCT age_group) AS age_groups_represented, {rnd('avg(avg_data_quality)', 1)} AS avg_data_quality,
  {big('sum(total_countries)')} AS total_countries_reached
FROM ages GROUP BY generation, registration_year, processing_date"""
LAYERS["v_fastest"] = f"""
SELECT age_group, generation, registration_year, total_users_in_group, trend_magnitude, trend_direction,
  percentage_of_year,
  {num('rank() OVER (PARTITION BY registration_year ORDER BY trend_magnitude DESC)')} AS growth_rank, processing_date
FROM ages WHERE trend_direction = 'Growing'"""
LAYERS["v_quality"] = f"""
SELECT processing_date, total_records, {rnd('avg_quality_score', 2)} AS avg_quality_score,
  excellent_quality_percentage, good_quality_percentage, email_validity_percentage, phone_validity_percentage,
  quality_trend, {rnd('quality_change', 2)} AS quality_change,
  CASE WHEN quality_trend = 'Improving' AND quality_change > 2 THEN 'Significantly Improving'
       WHEN quality_trend = 'Declining' AND quality_change < -2 THEN 'Significantly Declining'
       ELSE quality_trend END AS quality_trend_intensity,
  lag(avg_quality_score) OVER (ORDER BY processing_date) AS previous_avg_quality
FROM qtrend"""
LAYERS["v_tracking"] = f"""
SELECT processing_date, avg_quality_score, quality_change, quality_trend,
  CASE WHEN quality_change > 0 THEN 'Positive' WHEN quality_change < 0 THEN 'Negative' ELSE 'Neutral' END AS change_direction,
  abs(quality_change) AS change_magnitude,
  excellent_quality_count + good_quality_count AS high_quality_records,
  {pct('excellent_quality_count + good_quality_count', 'total_records')} AS high_quality_percentage, total_records
FROM qtrend"""
LAYERS["v_reg_odd"] = f"""
SELECT period_type, time_period, registrations, {rnd('z_score', 2)} AS z_score, anomaly_type, anomaly_severity,
  growth_rate, CASE anomaly_severity WHEN 'Critical' THEN 'Immediate Attention Required'
    WHEN 'High' THEN 'Investigation Recommended' WHEN 'Medium' THEN 'Monitor Closely'
    ELSE 'Normal Variation' END AS action_required, processing_date
FROM reg_odd WHERE is_anomaly"""
LAYERS["v_q_odd"] = f"""
SELECT processing_date, {rnd('avg_quality_score', 2)} AS avg_quality_score, {rnd('z_score', 2)} AS z_score,
  anomaly_type, anomaly_severity, quality_trend, {rnd('quality_change', 2)} AS quality_change,
  CASE anomaly_severity WHEN 'Critical' THEN 'Data Quality Crisis' WHEN 'High' THEN 'Quality Issue Detected'
    WHEN 'Medium' THEN 'Quality Variation' ELSE 'Normal Quality Range' END AS quality_status, total_records
FROM q_odd WHERE is_anomaly"""
LAYERS["v_dashboard"] = """
SELECT 'Registration Growth' AS metric_category, 'Monthly' AS metric_type, time_period AS period,
  CAST(registrations AS VARCHAR) AS value, coalesce(growth_rate, 0e0) AS growth_rate, processing_date
FROM monthly_rows
UNION ALL
SELECT 'Geographic Expansion', 'Top Countries', country, CAST(user_count AS VARCHAR), user_acquisition_rate,
  processing_date FROM expansion WHERE user_count_rank <= 5
UNION ALL
SELECT 'Data Quality', 'Trend', CAST(processing_date AS VARCHAR), CAST(avg_quality_score AS VARCHAR),
  coalesce(quality_change, 0e0), processing_date FROM qtrend"""
LAYERS["v_alerts"] = """
SELECT 'Registration' AS anomaly_category, time_period AS identifier, anomaly_severity AS severity,
  anomaly_type AS type, z_score, CAST(registrations AS DOUBLE) AS metric_value, processing_date
FROM reg_odd WHERE is_anomaly AND anomaly_severity IN ('Critical', 'High')
UNION ALL
SELECT 'Data Quality', CAST(processing_date AS VARCHAR), anomaly_severity, anomaly_type, z_score, avg_quality_score,
  processing_date FROM q_odd WHERE is_anomaly AND anomaly_severity IN ('Critical', 'High')"""
LAYERS["v_business"] = f"""
SELECT m.time_period AS month, m.registrations AS new_registrations, m.growth_rate AS registration_growth_rate,
  m.countries_represented AS countries_active, {rnd('m.avg_age_at_registration', 1)} AS avg_new_user_age,
  q.avg_quality_score AS data_quality_score, q.quality_trend AS quality_direction,
  CASE WHEN m.growth_rate > 0 AND q.quality_trend = 'Improving' THEN 'Excellent'
       WHEN m.growth_rate > 0 OR q.quality_trend = 'Improving' THEN 'Good'
       WHEN m.growth_rate < -10 OR q.quality_trend = 'Declining' THEN 'Needs Attention'
       ELSE 'Stable' END AS overall_performance, m.processing_date
FROM monthly_rows m LEFT JOIN qtrend q USING (processing_date)"""
LAYERS["v_insights"] = f"""
SELECT expansion_category, processing_date, count(*) AS countries_in_category,
  {big('sum(user_count)')} AS total_users, {rnd('avg(user_acquisition_rate)', 4)} AS avg_acquisition_rate,
  {rnd('avg(market_share_percentage)', 2)} AS avg_market_share, min(first_user_date) AS earliest_entry_date,
  max(first_user_date) AS latest_entry_date, {rnd('avg(avg_user_age)', 1)} AS avg_user_age_in_category
FROM expansion GROUP BY expansion_category, processing_date"""
LAYERS["high"] = "SELECT segment_count, avg_business_email_pct FROM v_engagement WHERE engagement_tier = 'High'"

# ---------------------------------------------------------------- statements

SQL: dict[str, str] = {}


def _all(source: str, exclude: str = "") -> str:
    return f"SELECT * {f'EXCLUDE ({exclude})' if exclude else ''} FROM {source}"


SQL |= {
    # sources and sinks
    **{
        name: f"SELECT {RAW12} FROM raw"
        for name in [
            "parse_user_json", "flatten_user_record", "src_parquet_users", "ext_table_raw_users",
            "incremental_ingest",
        ]
    },
    **{
        name: f"SELECT {RAW13} FROM raw"
        for name in [
            "src_table_or_path", "file_format_parquet", "sink_parquet_overwrite", "sink_table",
            "sink_table_fallback",
        ]
    },
    "conformance_rows": """
SELECT t AS table_name, c AS column_name, d AS declared_type, s AS stored_type, 'type' AS difference, n AS filled,
  0::BIGINT AS unfit
FROM (
  SELECT 'users_transformed', 'data_quality_score', 'double', 'int', count(data_quality_score) FROM u
  UNION ALL SELECT 'users_transformed', 'quality_issues', 'string', 'array<string>', count(*) FROM u
  UNION ALL SELECT 'dim_user_demographics', 'data_quality_score', 'double', 'int', count(data_quality_score) FROM dim
  UNION ALL SELECT 'dim_user_demographics', 'demographic_score', 'double', 'int', count(demographic_score) FROM dim
  UNION ALL SELECT 'fact_age_generation_analysis', 'engagement_score', 'double', 'int', count(engagement_score) FROM agegen
  UNION ALL SELECT 'fact_data_quality_metrics', 'min_quality_score', 'double', 'int', count(min_quality_score) FROM dq
  UNION ALL SELECT 'fact_data_quality_metrics', 'max_quality_score', 'double', 'int', count(max_quality_score) FROM dq
) found(t, c, d, s, n)
UNION ALL SELECT 'dim_user_demographics', c, p, p, 'partition', NULL, NULL
FROM (VALUES ('target_segment', 'string'), ('processing_date', 'date')) moved(c, p)""",
    "evolve_declared_types": """
SELECT * REPLACE (
  CAST(data_quality_score AS DOUBLE) AS data_quality_score,
  '[' || replace(quality_issues, '|', ', ') || ']' AS quality_issues
) FROM u""",
    # Records without an id are kept as often as they come: early ones four times, the others twice.
    "ingest_repeated_records": """
SELECT * EXCLUDE (processing_date) FROM u
UNION ALL SELECT * EXCLUDE (processing_date, again) FROM (
  SELECT *, unnest(range(CASE WHEN processing_date < '2024-10-05' THEN 3 ELSE 1 END)) AS again FROM u
  WHERE id IS NULL OR id = ''
)""",
    # Each run makes its quality summary and the row of distinct users under its last date.
    "daily_runs": """
SELECT layer, processing_date AS batch, count(*) AS records
FROM raw, (VALUES ('raw'), ('users'), ('facts'), ('quality trend')) AS layers(layer) GROUP BY ALL
UNION ALL SELECT 'dimension', processing_date, count(DISTINCT id) FROM raw GROUP BY ALL
UNION ALL SELECT 'quality baselines', min(processing_date), 1 FROM raw
UNION ALL SELECT 'quality summary', last, (SELECT count(*) FROM raw WHERE processing_date BETWEEN first AND last)
FROM (VALUES ('2024-10-05', '2024-10-08'), ('2024-10-09', '2024-10-12'), ('2024-10-01', '2024-10-04')) r(first, last)
UNION ALL SELECT 'distinct users', '2024-10-08', count(DISTINCT id) FROM raw WHERE processing_date BETWEEN '2024-10-05' AND '2024-10-08'
UNION ALL SELECT 'distinct users', '2024-10-12', count(DISTINCT id) FROM raw WHERE processing_date BETWEEN '2024-10-05' AND '2024-10-12'
UNION ALL SELECT 'distinct users', '2024-10-04', count(DISTINCT id) FROM raw
UNION ALL SELECT 'analytics', NULL, count(*) FROM raw""",
    "sink_json_csv": f"SELECT {RAW12}, unnest(['json', 'csv']) AS file_format FROM raw",
    "ext_table_user_analytics": _all("metrics"),
    "ext_table_user_demographics": _all("places"),
    "process_user_batch": _all("metrics"),
    "temp_views": "SELECT gender, count(*) AS users, count(DISTINCT username) AS usernames FROM raw GROUP BY gender",
    "register_silver_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {layer}"
        for name, layer in {
            "users_transformed": "u", "dim_user_demographics": "dim", "fact_geographic_analysis": "geo",
            "fact_age_generation_analysis": "agegen", "fact_email_provider_analysis": "providers",
            "fact_email_domain_analysis": "domains", "fact_data_quality_metrics": "dq",
            "fact_quality_by_segment": "segments", "fact_registration_trends": "regs",
            "fact_geographic_expansion": "expansion", "fact_age_demographic_trends": "ages",
            "fact_data_quality_trends": "qtrend", "fact_registration_anomalies": "reg_odd",
            "fact_quality_anomalies": "q_odd", "data_quality_summary": "dq",
        }.items()
    ),
    "create_tables_from_schema": _all("u"),
    "conform_to_schema": _all("u"),
    # row rules
    "quality_init": "SELECT picture, data_quality_score, quality_issues FROM scored",
    "rule_missing_id": "SELECT id, picture, bad_id AS missing_id FROM judged",
    "rule_invalid_email": "SELECT picture, email, email_valid, NOT email_valid AS invalid_email FROM judged",
    "rule_invalid_phone": "SELECT picture, phone, phone_valid, NOT phone_valid AS invalid_phone FROM judged",
    "clean_names": "SELECT picture, first_name_clean, last_name_clean, full_name FROM scored",
    "birth_date_and_age": f"SELECT picture, dob, {text('birth_date')} AS birth_date, age_years FROM scored",
    "age_group": "SELECT picture, age_years, age_group FROM rich",
    "generation": "SELECT picture, age_years, generation FROM rich",
    "email_domain": "SELECT picture, email, email_domain FROM rich",
    "email_provider_type": "SELECT picture, email_domain, email_provider_type FROM rich",
    "address_fields": "SELECT picture, address, array_to_string(parts, '|') AS address_parts, street_address, city,"
    " state_country FROM rich",
    "country": "SELECT picture, address, country FROM rich",
    "phone_fields": "SELECT picture, phone, phone_clean, phone_formatted FROM rich",
    "registration_and_account_age": f"SELECT picture, {text('registration_date')} AS registration_date,"
    " account_age_days FROM rich",
    "account_tenure_category": "SELECT picture, account_age_days, account_tenure_category FROM rich",
    "processing_metadata": "SELECT picture, processed_at, processing_date, data_source, glue_job_name FROM rich",
    "users_transformed": _all("u"),
    # cleaning job aggregates
    "data_quality_summary": f"""
SELECT count(*) AS total_records, {cnt('data_quality_score >= 80')} AS high_quality_records,
  {cnt('data_quality_score BETWEEN 50 AND 79')} AS medium_quality_records,
  {cnt('data_quality_score < 50')} AS low_quality_records, avg(data_quality_score) AS avg_quality_score,
  {cnt('email_valid')} AS valid_emails, {cnt('phone_valid')} AS valid_phones,
  count(DISTINCT email_domain) AS unique_email_domains, count(DISTINCT country) AS unique_countries,
  {NOW} AS quality_check_timestamp, {TODAY_TEXT} AS processing_date, 'userlake' AS glue_job_name
FROM u""",
    "age_generation_pct": "SELECT age_group, generation, user_count AS count, percentage FROM v_agegen",
    "quality_tier_distribution": _all("v_tiers"),
    # ingest summaries
    "gender_distribution": _all("genders"),
    "email_domain_top10": _all("domains10"),
    "general_metrics": _all("generals"),
    "user_analytics": _all("metrics"),
    "users_with_location": "SELECT picture, address, country, state FROM located",
    "country_distribution": _all("countries_raw"),
    "state_distribution_top10": _all("states10"),
    "user_demographics": _all("places"),
    # dimension and facts
    "dim_user_demographics": _all("dim"),
    "country_stats": _all("geo_country"),
    "city_stats": _all("geo_city"),
    "fact_geographic_analysis": _all("geo"),
    "fact_age_generation_analysis": _all("agegen"),
    "engagement_tier": "SELECT age_group, generation, gender, processing_date, engagement_score, engagement_tier"
    " FROM agegen",
    "fact_email_domain_analysis": _all("domains"),
    "fact_email_provider_analysis": _all("providers"),
    "fact_data_quality_metrics": _all("dq"),
    "fact_quality_by_segment": _all("segments"),
    # trends
    "registration_calendar": "SELECT picture, registration_date, registration_year, registration_month,"
    " registration_quarter, registration_day_of_week, registration_day_name FROM calendar",
    "monthly_trends": _all("months"),
    "quarterly_trends": _all("quarters"),
    "day_of_week_trends": _all("weekdays"),
    "fact_registration_trends": _all("regs"),
    "fact_geographic_expansion": _all("expansion"),
    "age_trends_daily": _all("agedays"),
    "fact_age_demographic_trends": _all("ages"),
    "fact_data_quality_trends": _all("qtrend"),
    "fact_registration_anomalies": _all("reg_odd"),
    "fact_quality_anomalies": _all("q_odd"),
    "detect_anomalies": f"""
SELECT geographic_level, processing_date, user_count, round(z_score, 6) AS z_score, is_anomaly, anomaly_type,
  anomaly_severity FROM ({_marked('geo_city', 'user_count', '1.5')})""",
    # views
    "vw_age_generation_distribution": _all("v_agegen"),
    "vw_data_quality_distribution": _all("v_tiers"),
    "vw_email_provider_analysis": "SELECT email_provider_type, count(*) AS user_count,"
    " count(DISTINCT email_domain) AS unique_domains FROM u GROUP BY 1",
    "vw_target_segment_distribution": _all("v_segments"),
    "vw_demographics_by_generation_age": "SELECT generation, age_group, count(*) AS users,"
    " count(DISTINCT country) AS countries, avg(demographic_score) AS avg_demographic_score"
    " FROM dim GROUP BY generation, age_group",
    "vw_top_countries": _all("v_countries", "processing_date"),
    "vw_geographic_diversity": _all("v_diversity"),
    "vw_cities_business_email_concentration": _all("v_cities"),
    "vw_engagement_by_generation": _all("v_engagement"),
    "vw_gender_by_age_group": _all("v_gender"),
    "vw_high_engagement_segments": "SELECT age_group, generation, gender, user_count, engagement_score,"
    " business_email_percentage, veteran_percentage FROM agegen WHERE engagement_tier = 'High'",
    "vw_email_provider_market_share": _all("v_share"),
    "vw_top_email_domains": "SELECT email_domain, email_provider_type, user_count, market_share_percentage,"
    " avg_user_age, countries_using, gender_ratio_male_female FROM domains WHERE user_count >= 2",
    "vw_email_provider_age_demographics": _all("v_provider_age"),
    "vw_data_quality_metrics": "SELECT processing_date, total_records, excellent_quality_percentage,"
    " good_quality_percentage, email_validity_percentage, phone_validity_percentage, data_completeness_score,"
    " avg_quality_score FROM dq",
    "vw_quality_by_segment": """
SELECT s.age_group, s.generation, s.segment_total, s.avg_segment_quality, s.segment_email_validity_rate,
  s.segment_phone_validity_rate, d.target_segment
FROM segments s LEFT JOIN (SELECT DISTINCT age_group, generation, target_segment FROM dim) d
  USING (age_group, generation)""",
    "vw_data_quality_batch_distribution": _all("v_batches"),
    "vw_bronze_vs_silver_completeness": _all("v_complete"),
    "vw_data_enrichment_impact": """
SELECT 'Raw Data Fields' AS data_type, count(*) AS record_count, 'Basic user info only' AS enrichment_level FROM raw
UNION ALL
SELECT 'Enriched Data Fields', count(*),
  'Added: age_group, generation, email_provider_type, data_quality_score, account_tenure_category' FROM u""",
    "vw_executive_summary": _all("v_summary"),
    "vw_monthly_registration_trends": _all("v_months"),
    "vw_quarterly_registration_performance": _all("v_quarters"),
    "vw_registration_day_patterns": _all("v_days"),
    "vw_top_growing_countries": _all("v_growing"),
    "vw_market_penetration_analysis": _all("v_penetration"),
    "vw_country_expansion_timeline": _all("v_timeline"),
    "vw_age_group_trends": _all("v_ages"),
    "vw_generation_performance_timeline": _all("v_generations"),
    "vw_fastest_growing_demographics": _all("v_fastest"),
    "vw_data_quality_trend_overview": _all("v_quality"),
    "vw_quality_improvement_tracking": _all("v_tracking"),
    "vw_registration_anomalies_summary": _all("v_reg_odd"),
    "vw_quality_anomalies_summary": _all("v_q_odd"),
    "vw_time_series_executive_dashboard": _all("v_dashboard"),
    "vw_anomaly_alert_dashboard": _all("v_alerts"),
    "vw_monthly_business_summary": _all("v_business"),
    "vw_geographic_expansion_insights": _all("v_insights"),
    # plain reads
    "read_completeness": _all("v_complete"),
    "read_top_countries": _all("v_countries", "processing_date")
    + " ORDER BY user_count DESC, country, processing_date LIMIT 10",
    "read_quality_distribution": _all("v_tiers"),
    "read_provider_market_share": _all("v_share"),
    "read_monthly_trends": _all("v_months") + " ORDER BY time_period DESC NULLS FIRST, processing_date DESC LIMIT 12",
    "read_quarterly_performance": _all("v_quarters"),
    "read_day_patterns": _all("v_days"),
    "read_top_growing_countries": _all("v_growing")
    + " ORDER BY user_acquisition_rate DESC, country, processing_date LIMIT 10",
    "read_quality_trend": _all("v_quality") + " ORDER BY processing_date DESC LIMIT 10",
    "read_anomaly_alerts": _all("v_alerts"),
    # combinations
    "segment_x_quality": """
SELECT s.target_segment, s.user_count, s.percentage AS demo_percentage, q.count AS quality_count,
  q.avg_score AS quality_score
FROM v_segments s LEFT JOIN v_tiers q
  ON s.avg_quality_score >= CASE q.quality_tier WHEN 'High Quality' THEN 80 WHEN 'Medium Quality' THEN 50 ELSE 0 END
 AND s.avg_quality_score <= CASE q.quality_tier WHEN 'High Quality' THEN 100 WHEN 'Medium Quality' THEN 79 ELSE 49 END""",
    "country_x_engagement": """
SELECT country, user_count AS country_users, business_email_percentage, segment_count AS high_engagement_segments,
  avg_business_email_pct AS engagement_business_email_pct
FROM v_countries LEFT JOIN high ON true WHERE user_count_rank <= 10""",
    "provider_x_age": """
SELECT s.email_provider_type, s.market_share_pct, a.avg_age AS provider_avg_age, a.unique_domains
FROM v_share s JOIN v_provider_age a USING (email_provider_type)""",
    "dashboard_top20": _all("v_dashboard")
    + " ORDER BY processing_date DESC, growth_rate DESC, metric_category, period LIMIT 20",
    "expansion_insights": "SELECT expansion_category, countries_in_category, total_users, avg_acquisition_rate,"
    " avg_market_share, earliest_entry_date, latest_entry_date FROM v_insights",
    "age_trend_top15": "SELECT age_group, generation, registration_year, trend_direction, trend_intensity,"
    " trend_magnitude, total_users_in_group FROM v_ages WHERE trend_direction = 'Growing'"
    " ORDER BY trend_magnitude DESC, registration_year DESC, age_group, generation, processing_date LIMIT 15",
    "executive_unpivot": """
SELECT 'Total Users' AS metric, CAST(total_users AS VARCHAR) AS value, 'users' AS unit FROM v_summary
UNION ALL SELECT 'Target Segments', CAST(target_segments AS VARCHAR), 'segments' FROM v_summary
UNION ALL SELECT 'Geographic Levels', CAST(geographic_levels AS VARCHAR), 'levels' FROM v_summary
UNION ALL SELECT 'Overall Quality Score', CAST(overall_quality_score AS VARCHAR), 'score' FROM v_summary""",
    "quality_health_check": " UNION ALL ".join(
        f"SELECT '{label}' AS quality_tier, count(*) AS batch_count, {rnd('avg(avg_score)', 2)} AS avg_score"
        f" FROM v_batches WHERE batch_quality_tier = '{tier}'"
        for label, tier in [
            ("Excellent Quality", "Excellent Batch"), ("Good Quality", "Good Batch"),
            ("Needs Improvement", "Needs Improvement"),
        ]
    ),
    "country_opportunity": """
SELECT c.country, c.user_count, c.business_email_percentage, t.geographic_level AS top_city,
  t.business_email_percentage AS city_business_pct
FROM v_countries c LEFT JOIN (SELECT * FROM v_cities
  ORDER BY business_email_percentage DESC, user_count DESC, geographic_level LIMIT 1) t ON true
WHERE c.user_count_rank <= 5""",
    "age_engagement_rate": f"""
SELECT DISTINCT age_group, total_users, segment_count AS high_engagement_count,
  {pct('segment_count', 'total_users')} AS engagement_rate_pct, avg_business_email_pct
FROM v_gender LEFT JOIN high ON true""",
    "monthly_business_12": _all("v_business", "processing_date")
    + " ORDER BY month DESC NULLS FIRST, processing_date DESC LIMIT 12",
    "expansion_timeline_20": "SELECT country, first_user_date, expansion_year, expansion_month, user_count,"
    " expansion_category, country_rank_in_year FROM v_timeline"
    " ORDER BY first_user_date DESC NULLS FIRST, country, processing_date LIMIT 20",
    "generation_performance_15": _all("v_generations", "processing_date")
    + " ORDER BY registration_year DESC NULLS FIRST, total_generation_users DESC, generation, processing_date LIMIT 15",
    # monitoring
    "gold_freshness": f"SELECT 'Gold Layer Views' AS layer, count(*) AS view_count, {NOW} AS last_update FROM v_summary",
    "low_quality_alert": """
SELECT 'LOW_QUALITY_ALERT' AS alert_type, batch_quality_tier, batch_count, avg_score,
  CASE WHEN avg_score < 30 THEN 'CRITICAL' WHEN avg_score < 50 THEN 'WARNING' ELSE 'OK' END AS severity
FROM v_batches WHERE batch_quality_tier = 'Needs Improvement' OR avg_score < 50""",
    "completeness_alert": """
SELECT 'COMPLETENESS_COMPARISON' AS alert_type, *,
  CASE WHEN layer = 'Silver Layer' AND emails_valid < emails_present * 0.8 THEN 'EMAIL_VALIDATION_LOW'
       WHEN layer = 'Silver Layer' AND phones_valid < phones_present * 0.8 THEN 'PHONE_VALIDATION_LOW'
       ELSE 'OK' END AS alert_status
FROM v_complete""",
    "registration_anomaly_alert": "SELECT 'REGISTRATION_ANOMALY' AS alert_type, period_type, time_period,"
    " registrations, z_score, anomaly_severity, action_required, processing_date FROM v_reg_odd"
    " WHERE anomaly_severity IN ('Critical', 'High')",
    "quality_anomaly_alert": "SELECT 'QUALITY_ANOMALY' AS alert_type, processing_date, avg_quality_score, z_score,"
    " anomaly_severity, quality_status, total_records FROM v_q_odd WHERE anomaly_severity IN ('Critical', 'High')",
    "quality_trend_alert": """
SELECT 'QUALITY_TREND_ALERT' AS alert_type, processing_date, quality_trend, change_direction, change_magnitude,
  high_quality_percentage,
  CASE WHEN change_direction = 'Negative' AND change_magnitude > 5 THEN 'CRITICAL_DECLINE'
       WHEN change_direction = 'Negative' AND change_magnitude > 2 THEN 'MODERATE_DECLINE'
       WHEN change_direction = 'Positive' AND change_magnitude > 5 THEN 'SIGNIFICANT_IMPROVEMENT'
       ELSE 'NORMAL_VARIATION' END AS trend_alert_level
FROM v_tracking WHERE change_direction <> 'Neutral' ORDER BY processing_date DESC LIMIT 10""",
    "growth_rate_alert": """
SELECT 'GROWTH_RATE_ALERT' AS alert_type, time_period, registrations, growth_rate, growth_category,
  CASE WHEN growth_rate < -20 THEN 'CRITICAL_DECLINE' WHEN growth_rate < -10 THEN 'MODERATE_DECLINE'
       WHEN growth_rate > 50 THEN 'EXCEPTIONAL_GROWTH' WHEN growth_rate > 20 THEN 'HIGH_GROWTH'
       ELSE 'NORMAL_GROWTH' END AS growth_alert_level
FROM v_months WHERE growth_rate IS NULL OR abs(growth_rate) > 10
ORDER BY processing_date DESC, abs(growth_rate) DESC NULLS FIRST, time_period DESC LIMIT 15""",
    "registration_x_quality": """
SELECT m.time_period AS month, m.registrations, m.growth_rate AS registration_growth, q.avg_quality_score,
  q.quality_change, q.quality_trend,
  CASE WHEN m.growth_rate > 0 AND q.quality_change > 0 THEN 'Growth with Quality Improvement'
       WHEN m.growth_rate > 0 AND q.quality_change < 0 THEN 'Growth with Quality Decline'
       WHEN m.growth_rate < 0 AND q.quality_change > 0 THEN 'Decline with Quality Improvement'
       WHEN m.growth_rate < 0 AND q.quality_change < 0 THEN 'Decline with Quality Decline'
       ELSE 'Mixed or Stable' END AS combined_trend_analysis
FROM v_months m LEFT JOIN v_quality q USING (processing_date)
ORDER BY m.time_period DESC NULLS FIRST, processing_date DESC LIMIT 12""",
    "demographics_x_expansion": """
SELECT f.age_group, f.generation, f.trend_magnitude, f.total_users_in_group, i.expansion_category,
  i.avg_acquisition_rate, i.total_users AS geo_total_users
FROM v_fastest f LEFT JOIN v_insights i USING (processing_date) WHERE f.growth_rank <= 5""",
    "penetration_x_days": """
SELECT p.expansion_category, p.country_count AS countries_in_category, p.total_users, d.day_name,
  d.registrations AS day_registrations, d.percentage_of_weekly_registrations
FROM v_penetration p CROSS JOIN v_days d WHERE d.popularity_rank <= 3""",
    "pipeline_health": f"""
SELECT 'Pipeline Health Check' AS report_type, count(DISTINCT m.time_period) AS months_with_data,
  avg(m.registrations) AS avg_monthly_registrations, avg(m.growth_rate) AS avg_growth_rate,
  count(DISTINCT e.country) AS countries_active, avg(q.avg_quality_score) AS avg_quality_score,
  {cnt('r.is_anomaly')} AS registration_anomalies, {cnt('o.is_anomaly')} AS quality_anomalies,
  {NOW} AS report_generated_at
FROM monthly_rows m LEFT JOIN expansion e ON m.processing_date = e.processing_date
LEFT JOIN qtrend q ON m.processing_date = q.processing_date
LEFT JOIN (SELECT * FROM reg_odd WHERE is_anomaly) r ON m.processing_date = r.processing_date
LEFT JOIN (SELECT * FROM q_odd WHERE is_anomaly) o ON m.processing_date = o.processing_date""",
    "timeseries_completeness": " UNION ALL ".join(
        f"SELECT 'Time Series Completeness' AS check_type, '{label}' AS table_name, count(*) AS total_records,"
        f" count(DISTINCT processing_date) AS unique_dates, min(processing_date) AS earliest_date,"
        f" max(processing_date) AS latest_date FROM {layer}"
        for label, layer in [
            ("Registration Trends", "regs"), ("Geographic Expansion", "expansion"),
            ("Age Demographic Trends", "ages"), ("Data Quality Trends", "qtrend"),
        ]
    ),
    # raw checks
    "latest_users_10": f"SELECT {RAW13} FROM raw"
    " ORDER BY registered_date DESC NULLS FIRST, id NULLS LAST, picture LIMIT 10",
    "total_users": "SELECT count(*) AS total_users FROM raw",
    "gender_from_analytics": "SELECT metric_name, metric_value AS count, percentage FROM genders",
    "gender_from_raw": f"SELECT gender, count(*) AS count,"
    f" {pct('count(*)', '(SELECT count(*) FROM raw)')} AS percentage FROM raw GROUP BY gender",
    "top_countries_10": "SELECT demographic_value AS country, user_count, percentage FROM countries_raw"
    " ORDER BY user_count DESC, country LIMIT 10",
    "top_states_10": "SELECT demographic_value AS state, user_count, percentage FROM states10",
    "domains_from_analytics": "SELECT replace(metric_name, 'domain_', '') AS email_domain, metric_value AS count,"
    " percentage FROM domains10",
    "domains_from_raw_10": f"SELECT d AS email_domain, n AS count, {pct('n', '(SELECT count(*) FROM raw)')}"
    " AS percentage FROM (SELECT split_part(email, '@', 2) AS d, count(*) AS n FROM raw GROUP BY 1)"
    " ORDER BY n DESC, d NULLS LAST LIMIT 10",
    "registrations_by_year": f"SELECT {num('year(' + iso_date('registered_date') + ')')} AS registration_year,"
    " count(*) AS user_count FROM raw GROUP BY 1",
    "age_distribution_raw": f"SELECT {AGE_LADDER.format('age')} AS age_group, count(*) AS count"
    f" FROM (SELECT 2025 - year({iso_date('dob')}) AS age FROM raw) GROUP BY 1",
    "gender_by_top5_country": """
SELECT country, gender, count(*) AS count
FROM (SELECT gender, string_split(string_split(address, ',')[-1], ' ')[-1] AS country FROM raw)
WHERE country IN (SELECT demographic_value FROM countries_raw ORDER BY user_count DESC, demographic_value LIMIT 5)
GROUP BY country, gender""",
    "bronze_data_checks": f"""
SELECT 'Missing IDs' AS check_type, count(*) AS count FROM raw WHERE id IS NULL OR id = ''
UNION ALL SELECT 'Missing emails', count(*) FROM raw WHERE email IS NULL OR email = ''
UNION ALL SELECT 'Invalid email format', count(*) FROM raw WHERE email NOT LIKE '%@%.%'
UNION ALL SELECT 'Future birth dates', count(*) FROM raw WHERE {iso_date('dob')} > {TODAY}""",
    "processing_recency": """
SELECT 'Analytics' AS data_type, max(created_at) AS latest_processing_time,
  count(DISTINCT created_at) AS processing_batches FROM metrics
UNION ALL SELECT 'Demographics', max(created_at), count(DISTINCT created_at) FROM places""",
    "processing_volume": "SELECT CAST(CAST(CAST(created_at AS TIMESTAMP) AS DATE) AS VARCHAR) AS processing_date,"
    " count(*) AS records_processed FROM metrics GROUP BY 1",
    # reports
    "report_segment_counts": "SELECT target_segment, count(*) AS count FROM dim GROUP BY 1",
    "report_top5_countries": "SELECT * FROM geo WHERE analysis_type = 'country'"
    " ORDER BY user_count DESC, geographic_level, processing_date LIMIT 5",
    "report_engagement_counts": "SELECT engagement_tier, count(*) AS count FROM agegen GROUP BY 1",
    "report_providers": _all("providers"),
    "report_quality_row": "SELECT total_records, avg_quality_score, excellent_quality_percentage,"
    " email_validity_percentage FROM dq",
    "report_last6_months": _all("monthly_rows") + " ORDER BY time_period DESC, processing_date DESC LIMIT 6",
    "report_fastest5_countries": _all("expansion")
    + " ORDER BY user_acquisition_rate DESC, country, processing_date LIMIT 5",
    "report_growing5_age_groups": "SELECT * FROM ages WHERE trend_direction = 'Growing'"
    " ORDER BY trend_magnitude DESC, registration_year DESC, age_group, generation, processing_date LIMIT 5",
    "report_recent3_quality": _all("qtrend") + " ORDER BY processing_date DESC LIMIT 3",
    "report_anomaly_counts": f"SELECT 'Registration' AS anomaly_source, {cnt('is_anomaly')} AS anomalies FROM reg_odd"
    f" UNION ALL SELECT 'Data Quality', {cnt('is_anomaly')} FROM q_odd",
}


def _mentioned(text: str) -> set[str]:
    return {name for name in LAYERS if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text)}


def _with_layers(statement: str) -> str:
    needed, open_names = set(), _mentioned(statement)
    while open_names:
        needed |= open_names
        open_names = {n for name in open_names for n in _mentioned(LAYERS[name])} - needed
    chain = ",\n".join(f"{name} AS ({LAYERS[name]})" for name in LAYERS if name in needed)
    return f"WITH {chain}\n{statement}"


def statements() -> dict[str, str]:
    complete = {}
    for name, statement in SQL.items():
        unstable = ORDER_DEPENDENT.get(name)
        if unstable:
            rounded = ", ".join(f"round({column}, 6) AS {column}" for column in unstable)
            statement = f"SELECT * REPLACE ({rounded}) FROM ({statement})"
        complete[name] = _with_layers(statement)
    return complete
