"""The explicit "as of" instant all time windows are measured from."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """An instant as UTC wall-clock time.

    Bounds are literals, so they reach the scan as pushed and partition filters.
    """

    at: datetime

    @classmethod
    def now(cls) -> AsOf:
        return cls(datetime.now(timezone.utc).replace(tzinfo=None))

    def day(self, days_back: int = 0) -> date:
        return (self.at - timedelta(days=days_back)).date()

    def time_ago(self, days: int = 0) -> Column:
        return F.lit((self.at - timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")

    def date_ago(self, days: int = 0) -> Column:
        return F.lit(self.day(days))
