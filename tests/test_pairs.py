"""Reports merged from stored days against the same reports from events."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import NOW, collected, event, frame
from pyspark.sql import functions as F

from forgepulse.clock import AsOf
from forgepulse.operators import community, profiles
from forgepulse.operators.activity import daily_pairs, daily_signals, pairs_since
from forgepulse.plans.layers import PAIRS, Build, read_model
from forgepulse.plans.pipeline import refresh_daily_tables, run_pipeline
from forgepulse.sources.storage import Scratch
from forgepulse.sources.warehouse import Warehouse

REPORTS = {
    "profiles": (90, lambda rows, events, as_of: profiles.int_contributor_profiles(rows, as_of)),
    "orgs": (30, lambda rows, events, as_of: profiles.int_org_activity(rows, as_of)),
    "migration": (90, lambda rows, events, as_of: community.mart_contributor_migration(
        rows, profiles.int_contributor_profiles(events, as_of), as_of
    )),
    "forks": (90, lambda rows, events, as_of: community.mart_fork_conversion(rows, daily_signals(events), as_of)),
    "releases": (90, lambda rows, events, as_of: community.mart_release_momentum(rows, as_of)),
}


def many_events(n=700):
    rng = random.Random(8)
    kinds = ["Push", "Fork", "PullRequest", "Issues", "Release", "Watch"]
    rows = []
    for _ in range(n):
        # Much on the first days of the windows, before and after the time they start at.
        days = rng.choice([0, 1, 5, 29, 30, 30, 31, 89, 90, 90, 91])
        org = rng.choice([None, 1, 2, 3])
        rows.append(event(
            rng.choice(kinds), repo=rng.choice([None, 1, 2, 3, 4]), name=rng.choice([None, "own/old"]),
            actor=rng.choice([None, 1, 2, 3, 4, 5]), login=rng.choice(["a", "b", "x[bot]", "y-bot", None]),
            org=org, org_login=org and f"org{org}",
            at=datetime(2024, 1, 31, rng.randint(0, 23), 59) - timedelta(days=days),
        ))
    return rows


@pytest.mark.parametrize("at", [NOW, datetime(2024, 1, 31), datetime(2024, 1, 31, 23, 59)])
@pytest.mark.parametrize("name", REPORTS)
def test_reports_from_days_equal_those_from_events(spark, name, at):
    days, report = REPORTS[name]
    events, as_of = frame(spark, many_events()), AsOf(at)
    merged = report(pairs_since(daily_pairs(events), events, as_of, days), events, as_of)
    plain = report(events, events, as_of)
    assert merged.schema.simpleString() == plain.schema.simpleString()
    assert collected(merged, *plain.columns) == collected(plain, *plain.columns) != []


def test_whole_days_need_no_events(spark, tmp_path):
    """At midnight a window reads stored days only; else the events of its first date."""
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.append_events(frame(spark, many_events(200)))
    build = Build(warehouse)
    with Scratch(spark) as scratch:
        refresh_daily_tables(build, scratch)
    build.publish()

    def scans(as_of):
        rows = pairs_since(read_model(warehouse, PAIRS), warehouse.events(), as_of, 90)
        plan = profiles.int_contributor_profiles(rows, as_of)._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "FileScan" in line]

    only, = scans(AsOf(datetime(2024, 1, 31)))
    assert "first_at#" in only and "PartitionFilters: [isnotnull(activity_date" in only
    stored, edge = scans(AsOf(NOW))
    assert "first_at#" in stored and "created_at#" in edge and "(event_date#" in edge.split("PartitionFilters")[1]


def test_days_are_refreshed_where_events_came(spark, tmp_path, as_of):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    rows = many_events(300)
    warehouse.append_events(frame(spark, rows[:200]))
    run_pipeline(warehouse, as_of)
    late = [row for row in rows[200:] if row["event_date"] > datetime(2024, 1, 1).date()]
    warehouse.append_events(frame(spark, late))
    run_pipeline(warehouse, as_of)
    stored, full = read_model(warehouse, PAIRS), daily_pairs(warehouse.events())
    assert collected(stored, *full.columns) == collected(full, *full.columns)
    entry = warehouse.version().get(f"intermediate/{PAIRS}")["segments"]
    assert len(entry) == 2 and sorted(day for days in entry.values() for day in days) == sorted(
        {str(day) for day in collected(full.select("activity_date").distinct(), "activity_date")}
    )
    stars = read_model(warehouse, "mart_fork_conversion").agg(F.sum("fork_count")).first()[0]
    assert stars == community.mart_fork_conversion(
        warehouse.events(), daily_signals(warehouse.events()), as_of
    ).agg(F.sum("fork_count")).first()[0]
