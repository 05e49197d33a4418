"""Per-type event views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse import rules
from forgepulse.schema import EVENT_COLUMNS

VIEWS = {
    "stg_watch_events": rules.WATCH,
    "stg_push_events": rules.PUSH,
    "stg_fork_events": rules.FORK,
    "stg_pull_request_events": rules.PULL_REQUEST,
    "stg_issue_events": rules.ISSUES,
    "stg_release_events": rules.RELEASE,
    "stg_create_events": rules.CREATE,
}

VIEW_COLUMNS = [name for name in EVENT_COLUMNS if name != "event_type"]


def events_of_type(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type).select(*VIEW_COLUMNS)


def staging_views(events: DataFrame) -> dict[str, DataFrame]:
    return {name: events_of_type(events, event_type) for name, event_type in VIEWS.items()}
