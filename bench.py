"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores. Each query runs once to warm up, which also puts its plan together, and
then three times; its figure is the median. `batch_jobs` is the second
run of all jobs from raw users to stored tables, `stored_views` one read of
every view over those tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from userlake.plans.gold import VIEWS
from userlake.plans.jobs import Lake, run_all
from userlake.session import COMPILE_LONG_METHODS
from userlake.sources.scratch import scratch_folder
from verification.queries import CONTEXT, raw_users, registered

HEADLINE = [
    "users_transformed", "data_quality_summary", "user_analytics", "user_demographics",
    "dim_user_demographics", "fact_geographic_analysis", "fact_age_generation_analysis",
    "fact_email_provider_analysis", "fact_email_domain_analysis", "fact_data_quality_metrics",
    "fact_quality_by_segment", "fact_registration_trends", "fact_geographic_expansion",
    "fact_age_demographic_trends", "fact_data_quality_trends", "fact_registration_anomalies",
    "fact_quality_anomalies", "vw_age_generation_distribution", "vw_top_countries",
    "vw_quality_by_segment", "vw_executive_summary", "vw_monthly_business_summary",
    "vw_anomaly_alert_dashboard", "country_x_engagement", "pipeline_health", "bronze_data_checks",
    "incremental_ingest",
]
RUNS = 3


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def time_jobs(spark: SparkSession, folder: str) -> dict[str, float]:
    lake = Lake(spark, "bench_lake", scratch_folder(spark, "bench"))
    stored = {}

    def jobs():
        stored.update(run_all(lake, raw_users(spark, folder), CONTEXT))

    def views():
        for name in VIEWS:
            stored[name].write.format("noop").mode("overwrite").save()

    try:
        jobs()
        return {"batch_jobs": round(seconds(jobs), 3), "stored_views": round(seconds(views), 3)}
    finally:
        spark.sql("DROP DATABASE bench_lake CASCADE")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # The customer tables and the cleaning rules fuse into one long generated method;
        # without this the JVM would interpret it instead of compiling it.
        .config("spark.driver.extraJavaOptions", COMPILE_LONG_METHODS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        def run(query=queries[name]):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        run()
        timings[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        timings |= time_jobs(spark, folder)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
