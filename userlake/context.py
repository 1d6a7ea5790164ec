"""Everything a run takes from the clock or from its job definition."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """The "today" and "now" of a run, so that a rerun gives the same rows."""

    as_of: date
    run_ts: datetime
    job_name: str = "userlake"
    data_source: str = "randomuser_api"

    @classmethod
    def now(cls, **names: str) -> RunContext:
        moment = datetime.now()
        return cls(as_of=moment.date(), run_ts=moment, **names)

    def today(self) -> Column:
        return F.lit(self.as_of)

    def timestamp(self) -> Column:
        # Through text, so that the session time zone alone decides its meaning.
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp")

    def iso_text(self) -> str:
        return self.run_ts.isoformat()
