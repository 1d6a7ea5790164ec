"""The named tables of the lake, each a DataFrame built from the ones it reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from userlake.context import RunContext
from userlake.functions.measures import down, up
from userlake.operators import anomalies, facts, summaries, trends, users
from userlake.plans import bronze, checks, gold, reports

if TYPE_CHECKING:
    Builder = Callable[["Tables"], DataFrame]

RAW = "raw_users"
USERS = "users_transformed"


class Tables(Mapping[str, DataFrame]):
    """Name -> DataFrame; a table is put together on first use and then kept."""

    def __init__(self, builders: Mapping[str, Builder], ctx: RunContext):
        self.ctx = ctx
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def unordered(self, name: str) -> DataFrame:
        """The rows of a table or view, for use inside another query."""
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        order = gold.ORDERS.get(name)
        rows = self.unordered(name)
        return rows.orderBy(*[down(c[1:]) if c.startswith("-") else up(c) for c in order]) if order else rows

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _of_users(step: Callable[[DataFrame, RunContext], DataFrame]) -> Builder:
    return lambda t: step(t[USERS], t.ctx)


def _of_raw(step: Callable[[DataFrame, RunContext], DataFrame]) -> Builder:
    return lambda t: step(t[RAW], t.ctx)


def registration_anomalies(t: Tables) -> DataFrame:
    monthly = t["fact_registration_trends"].filter("period_type = 'monthly'")
    return anomalies.detect_anomalies(monthly, "registrations")


def quality_anomalies(t: Tables) -> DataFrame:
    return anomalies.detect_anomalies(t["fact_data_quality_trends"], "avg_quality_score")


INGEST_SUMMARIES: dict[str, Builder] = {
    "user_analytics": _of_raw(summaries.user_analytics),
    "user_demographics": _of_raw(summaries.user_demographics),
}

SILVER: dict[str, Builder] = {
    "users_transformed": _of_raw(users.users_transformed),
    "data_quality_summary": _of_users(users.data_quality_summary),
    "dim_user_demographics": _of_users(facts.user_demographics),
    "fact_geographic_analysis": _of_users(facts.geographic_analysis),
    "fact_age_generation_analysis": _of_users(facts.age_generation_analysis),
    "fact_email_provider_analysis": _of_users(facts.email_provider_analysis),
    "fact_email_domain_analysis": _of_users(facts.email_domain_analysis),
    "fact_data_quality_metrics": _of_users(facts.data_quality_metrics),
    "fact_quality_by_segment": _of_users(facts.quality_by_segment),
    "fact_registration_trends": _of_users(trends.registration_trends),
    "fact_geographic_expansion": _of_users(trends.geographic_expansion),
    "fact_age_demographic_trends": _of_users(trends.age_demographic_trends),
    "fact_data_quality_trends": _of_users(trends.data_quality_trends),
    "fact_registration_anomalies": registration_anomalies,
    "fact_quality_anomalies": quality_anomalies,
}

# What the jobs keep besides: the quality figures of each batch, and each user id under the batch it is counted in.
DAILY_FIGURES = "daily_quality_figures"
KNOWN_USERS = "known_users"

# Partition columns on disk: each run replaces the partitions of its own dates.
PARTITIONS: dict[str, list[str]] = {name: ["processing_date"] for name in [RAW, *SILVER, DAILY_FIGURES, KNOWN_USERS]}

READERS: dict[str, Builder] = {**gold.VIEWS, **checks.CHECKS, **bronze.CHECKS, **reports.REPORTS}


def tables_from_raw(raw: DataFrame, ctx: RunContext) -> Tables:
    """Every table, derived lazily from raw user records."""
    return Tables({RAW: lambda _: raw, **INGEST_SUMMARIES, **SILVER, **READERS}, ctx)


def tables_from_store(spark: SparkSession, database: str, ctx: RunContext) -> Tables:
    """Stored tables read from the catalog; views, checks and reports on top of them."""

    def stored(name: str) -> Builder:
        return lambda _: spark.table(f"{database}.{name}")

    kept = {name: stored(name) for name in [RAW, *INGEST_SUMMARIES, *SILVER]}
    return Tables({**kept, **READERS}, ctx)
