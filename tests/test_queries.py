"""Every registered query against its SQL in DuckDB, and the shape of their plans."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from forgepulse.binding import AS_OF, bound_events, bound_metadata, event_table
from forgepulse.operators import community, profiles, trending
from forgepulse.operators.activity import daily_signals
from forgepulse.sources.storage import Scratch

DATA = "/root/testdata/sf0.001"

# Spark types and the DuckDB types they are compared as.
TYPES = {
    "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    yield connection
    connection.close()


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(registry.own_queries()) <= set(registry.oracle_sql())
    assert len(registry.own_queries()) >= 33


@pytest.mark.parametrize("name", list(registry.own_queries()))
def test_query_equals_its_sql(spark, duck, name):
    ours = registry.own_queries()[name](spark, DATA)
    result = duck.execute(registry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    assert {field.name: TYPES[field.dataType.simpleString()] for field in ours.schema} == types
    assert _sorted_rows(ours.columns, ours.collect()) == _sorted_rows(names, result.fetchall())


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


WINDOWED = {
    "profiles": profiles.int_contributor_profiles,
    "orgs": profiles.int_org_activity,
    "hourly": community.mart_ecosystem_hourly,
    "releases": community.mart_release_momentum,
    "velocity": lambda events, as_of: community.mart_viral_velocity(daily_signals(events), as_of),
}


@pytest.mark.parametrize("name", WINDOWED)
def test_windows_prune_dates_and_columns(spark, name):
    _, events = event_table(spark, DATA)
    plan = _plan(WINDOWED[name](events, AS_OF))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1, "one pass over the events"
    assert "PartitionFilters: [isnotnull(event_date" in scans[0]
    assert "source_file" not in scans[0] and "event_id" not in scans[0]
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_stars_of_all_history_are_totalled_for_forked_repositories_only(spark):
    """From the daily table, two columns of it, and semi-joined before they are totalled."""
    _, events = event_table(spark, DATA)
    signals = Scratch(spark).keep(daily_signals(events), name="signals")
    plan = _plan(community.mart_fork_conversion(events, signals, AS_OF))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "stars#" in line]
    assert len(scans) == 1 and scans[0].index("[repo_id#") < scans[0].index("stars#") < scans[0].index("Batched")
    assert "event_type" not in plan and "LeftSemi" in plan


def test_ai_filter_reaches_the_metadata(spark):
    """Only AI repositories are joined, though the filter is written after an outer join."""
    trending_rows = registry.trending_repos(spark, DATA)
    by_topic = trending.mart_trending_by_topic(trending_rows, bound_metadata(spark, DATA))
    plan = trending.mart_ai_ecosystem(by_topic, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter, (repo_id" not in plan


def test_stored_events_equal_the_binding(spark):
    _, stored = event_table(spark, DATA)
    bound = bound_events(spark, DATA)
    assert stored.count() == bound.count() and stored.exceptAll(bound).isEmpty()
