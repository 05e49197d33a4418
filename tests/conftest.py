from __future__ import annotations

import sys
from datetime import datetime, timedelta
from itertools import count
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from forgepulse.clock import AsOf  # noqa: E402
from forgepulse.schema import EVENTS, METADATA  # noqa: E402
from forgepulse.session import build_session  # noqa: E402

# Midday, so that windows by date and windows by time differ.
NOW = datetime(2024, 1, 31, 12)
_ids = count(1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("catalog")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return AsOf(NOW)


def days_ago(days, hour=10):
    """A time on the date `days` before the clock's."""
    return datetime(2024, 1, 31, hour) - timedelta(days=days)


def event(kind, repo=1, name=None, actor=1, login="someone", org=None, org_login=None, at=None,
          event_id=None, file="2024-01-31-10"):
    """One event row; the repository's name follows from its id unless given."""
    return {
        "event_id": next(_ids) if event_id is None else event_id,
        "event_type": f"{kind}Event" if kind else None,
        "actor_id": actor, "actor_login": login, "repo_id": repo,
        "repo_name": f"own/r{repo}" if name is None else name,
        "org_id": org, "org_login": org_login,
        "created_at": days_ago(0) if at is None else at, "source_file": file,
        "event_date": (days_ago(0) if at is None else at).date(),
    }


def frame(spark, rows):
    return spark.createDataFrame([tuple(row[name] for name in EVENTS.names) for row in rows], EVENTS)


def metadata(spark, *rows):
    defaults = {name: None for name in METADATA.names}
    filled = [defaults | row for row in rows]
    return spark.createDataFrame([tuple(row[name] for name in METADATA.names) for row in filled], METADATA)


def collected(df, *columns):
    """The chosen columns as a sorted list of tuples, or of values for one column."""
    rows = [tuple(row) for row in df.select(*columns).collect()]
    rows.sort(key=lambda row: [(value is not None, value) for value in row])
    return [row[0] for row in rows] if len(columns) == 1 else rows


def by_key(df, key, *columns):
    return {row[key]: tuple(row[name] for name in columns) for row in df.collect()}
