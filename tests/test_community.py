"""Contributors, organisations and per-repository reports."""

from __future__ import annotations

from datetime import datetime

from conftest import NOW, by_key, collected, days_ago, event, frame
from datetime import timedelta
from pyspark.sql import functions as F

from forgepulse import binding
from forgepulse.functions.ranking import with_rank
from forgepulse.operators.community import (
    mart_contributor_migration, mart_ecosystem_hourly, mart_fork_conversion, mart_org_scoreboard,
    mart_release_momentum, mart_viral_velocity,
)
from forgepulse.operators.activity import daily_signals
from forgepulse.operators.profiles import int_contributor_profiles, int_org_activity

DATA = "/root/testdata/sf0.001"


def test_contributor_types(spark, as_of):
    rows = [
        *[event("Push", actor=1, repo=n) for n in range(5)],
        *[event("Watch", actor=2, repo=n) for n in range(10)],
        *[event("PullRequest", actor=3, repo=n) for n in range(2)],
        event("Push", actor=4),
        *[event("Watch", actor=5, repo=n) for n in range(10)],
        *[event("PullRequest", actor=5, repo=n) for n in range(5)],
        *[event("Watch", actor=6, repo=n) for n in range(10)], event("Push", actor=6),
    ]
    profiles = int_contributor_profiles(frame(spark, rows), as_of)
    assert by_key(profiles, "actor_id", "contributor_type") == {
        1: ("polyglot_contributor",), 2: ("scout",), 3: ("active_contributor",), 4: ("casual",),
        5: ("polyglot_contributor",), 6: ("casual",),
    }


def test_contributor_counts(spark, as_of):
    rows = [
        event("Push", repo=1, at=days_ago(2)), event("Push", repo=1, at=days_ago(1)),
        event("Issues", repo=2, at=days_ago(1)), event("Watch", repo=3, at=days_ago(1)),
        event("Fork", repo=None, at=days_ago(0)),
    ]
    row = int_contributor_profiles(frame(spark, rows), as_of).first()
    assert (row.repos_contributed_to, row.repos_pushed_to, row.repos_pr_to) == (3, 1, 0)
    assert (row.repos_issues_on, row.repos_starred, row.total_events, row.active_days) == (1, 1, 5, 3)
    assert (row.first_seen, row.last_seen) == (days_ago(2), days_ago(0))


def test_contributor_window_bots_and_missing_logins(spark, as_of):
    edge = NOW - timedelta(days=90)
    rows = [
        event("Push", actor=1, at=edge), event("Push", actor=2, at=edge - timedelta(minutes=1)),
        event("Push", actor=3, login="x[bot]"), event("Push", actor=4, login="x-bot"),
        event("Push", actor=5, login=None), event("Push", actor=6, login="x-bot-y"),
    ]
    assert collected(int_contributor_profiles(frame(spark, rows), as_of), "actor_id") == [1, 6]


def test_profiles_equal_plain_distinct_counts(spark):
    events = binding.bound_events(spark, DATA)
    ours = int_contributor_profiles(events, binding.AS_OF)
    plain = (
        events.where("created_at >= timestamp_ntz '2023-11-02 00:00:00'")
        .where("actor_login not like '%[bot]%' and actor_login not like '%-bot'")
        .groupBy("actor_id", "actor_login")
        .agg(
            F.count_distinct("repo_id").alias("repos_contributed_to"),
            F.count_distinct(F.expr("if(event_type = 'PushEvent', repo_id, null)")).alias("repos_pushed_to"),
            F.count_distinct(F.to_date("created_at")).alias("active_days"),
            F.count("*").alias("total_events"),
        )
    )
    assert ours.count() == plain.count()
    assert ours.select(*plain.columns).exceptAll(plain).isEmpty()


def test_org_counts_window_and_missing_login(spark, as_of):
    rows = [
        event("Push", repo=1, actor=1, org=1, org_login="a"),
        event("PullRequest", repo=2, actor=1, org=1, org_login="a"),
        event("Release", repo=2, actor=2, org=1, org_login="a"),
        event("Watch", repo=2, actor=None, org=1, org_login="a"),
        event("Push", org=2, org_login=None), event("Push", org=None, org_login="c"),
        event("Push", org=4, org_login="d", at=NOW - timedelta(days=30, minutes=1)),
    ]
    row, = int_org_activity(frame(spark, rows), as_of).collect()
    assert (row.org_id, row.repos_active, row.unique_contributors) == (1, 2, 2)
    assert (row.unique_pushers, row.unique_pr_authors, row.total_events) == (1, 1, 4)
    assert (row.push_events, row.pr_events, row.release_events, row.star_events) == (1, 1, 1, 1)


def test_org_tiers_and_tied_ranks(spark, as_of):
    def org(org_id, contributors, repos=2):
        return [
            event("Push", repo=10 * org_id + n % repos, actor=n, org=org_id, org_login=f"o{org_id}")
            for n in range(contributors)
        ]

    rows = [*org(1, 50), *org(2, 10), *org(3, 10), *org(4, 3), *org(5, 2), *org(6, 60, repos=1)]
    report = mart_org_scoreboard(int_org_activity(frame(spark, rows), as_of))
    assert by_key(report, "org_id", "org_tier", "activity_rank", "push_ratio", "contributors_per_repo") == {
        1: ("enterprise", 1, 1.0, 25.0), 2: ("mid_size", 2, 1.0, 5.0), 3: ("mid_size", 2, 1.0, 5.0),
        4: ("startup", 4, 1.0, 1.5), 5: ("indie", 5, 1.0, 1.0),
    }


def test_rank_equals_the_window_function(spark):
    rows = spark.range(500).select("id", (F.col("id") * 7 % 23).alias("value"), (F.col("id") % 3).alias("day"))
    rows.createOrReplaceTempView("ranked_rows")
    window = spark.sql(
        "select id, rank() over (partition by day order by value desc) r, "
        "rank() over (order by value desc) g from ranked_rows"
    )
    expected = by_key(window, "id", "r", "g")
    ours = with_rank(with_rank(rows, "value", "r", by=["day"]), "value", "g")
    assert by_key(ours, "id", "r", "g") == expected


def test_no_window_over_all_organisations(spark, as_of):
    """The only single partition is that of the distinct totals."""
    orgs = int_org_activity(binding.bound_events(spark, DATA), binding.AS_OF)
    plan = mart_org_scoreboard(orgs)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "_ties" in windows[0] and "org_login" not in windows[0]


def test_hourly_window_edges(spark, as_of):
    edge = NOW - timedelta(days=7)
    rows = [
        event("Push", at=edge - timedelta(minutes=1)), event("Push", actor=1, at=edge),
        event("Push", actor=1, repo=2, at=edge + timedelta(minutes=59)),
        event("Push", actor=None, repo=3, at=edge), event("Watch", actor=None, at=edge),
    ]
    report = mart_ecosystem_hourly(frame(spark, rows), as_of)
    columns = ["event_count", "unique_actors", "unique_repos", "events_per_actor", "repos_per_actor"]
    assert by_key(report, "event_type", "activity_hour", *columns) == {
        "PushEvent": (datetime(2024, 1, 24, 12), 3, 1, 3, 3.0, 3.0),
        "WatchEvent": (datetime(2024, 1, 24, 12), 1, 0, 1, None, None),
    }


def _migration(spark, as_of, rows):
    events = frame(spark, rows)
    return mart_contributor_migration(events, int_contributor_profiles(events, as_of), as_of)


def test_migration_logins_bots_and_missing_orgs(spark, as_of):
    def in_orgs(actor, login, *orgs):
        return [event("Push", actor=actor, login=login, org=n, org_login=name) for n, name in orgs]

    rows = [
        *in_orgs(1, "x-bot", (1, "a"), (2, "b")),
        *in_orgs(2, "y[bot]", (1, "a"), (2, "b")),
        *in_orgs(3, None, (1, "a"), (2, "b")),
        *in_orgs(4, "first", (1, "a"), (2, "b")), *in_orgs(4, "second", (1, "a"), (2, "b")),
        *in_orgs(5, "plain", (2, "b"), (1, "a"), (3, None), (1, "a")),
        *in_orgs(6, "single", (1, "a"), (3, None)),
        event("Watch", actor=7, login="w", org=1, org_login="a"),
        event("Push", actor=7, login="w", org=2, org_login="b"),
    ]
    report = _migration(spark, as_of, rows)
    assert collected(report, "actor_id", "actor_login", "org_count", "total_cross_org_events") == [
        (1, "x-bot", 2, 2), (4, "first", 2, 2), (4, "first", 2, 2),
        (4, "second", 2, 2), (4, "second", 2, 2), (5, "plain", 2, 4),
    ]
    profiles = by_key(report, "actor_id", "orgs", "contributor_type", "repos_contributed_to")
    assert profiles[1] == (["a", "b"], None, None) and profiles[5] == (["a", "b"], "casual", 1)


def _fork_conversion(spark, as_of, rows):
    events = frame(spark, rows)
    return mart_fork_conversion(events, daily_signals(events), as_of)


def test_fork_health(spark, as_of):
    def repo(n, forks, requests):
        return [event("Fork", repo=n, actor=i) for i in range(forks)] + [
            event("PullRequest", repo=n, actor=i % 2) for i in range(requests)
        ]

    rows = [
        *repo(1, 4, 2), *repo(2, 4, 1), *repo(3, 3, 0), *repo(4, 2, 0), *repo(5, 1, 5), *repo(6, 3, 1),
        event("Watch", repo=1, at=days_ago(200)), event("Fork", repo=4, at=days_ago(91)),
        *[event("Fork", repo=None, name="x/y") for _ in range(2)], event("Watch", repo=None, name="x/y"),
    ]
    report = _fork_conversion(spark, as_of, rows)
    columns = ["fork_count", "pr_count", "star_count", "fork_to_pr_conversion", "community_health"]
    assert by_key(report, "repo_id", *columns) == {
        1: (4, 2, 1, 0.5, "thriving"), 2: (4, 1, 0, 0.25, "growing"), 3: (3, 0, 0, 0.0, "fork_graveyard"),
        4: (2, 0, 0, 0.0, "early_stage"), 6: (3, 1, 0, 0.333, "growing"),
        None: (2, 0, 0, 0.0, "early_stage"),
    }
    authors = by_key(report, "repo_id", "unique_forkers", "unique_pr_authors", "owner")
    assert authors[1] == (4, 2, "own") and authors[None] == (1, 0, "x")


def test_fork_counts_are_per_name_but_requests_per_repository(spark, as_of):
    rows = [event("Fork", name=name, actor=n) for name in ("a/old", "a/new") for n in range(2)]
    rows += [event("PullRequest", name=name, actor=1) for name in ("a/old", "a/new", "a/other")]
    report = _fork_conversion(spark, as_of, rows)
    assert collected(report, "repo_name", "fork_count", "pr_count", "unique_pr_authors") == [
        ("a/new", 2, 3, 1), ("a/old", 2, 3, 1),
    ]


def test_release_stages(spark, as_of):
    def repo(n, releases, authors, pushes=1):
        return (
            [event("Release", repo=n) for _ in range(releases)]
            + [event("PullRequest", repo=n, actor=i) for i in range(authors)]
            + [event("Push", repo=n) for _ in range(pushes)]
        )

    rows = [
        *repo(1, 5, 3), *repo(2, 3, 1), *repo(3, 1, 0), *repo(4, 1, 0, pushes=0), *repo(5, 5, 0),
        event("Watch", repo=1, at=days_ago(200)), event("Watch", repo=1, at=days_ago(2)),
    ]
    report = mart_release_momentum(frame(spark, rows), as_of)
    columns = ["release_count", "star_count", "releases_per_30_days", "prs_per_release", "project_stage"]
    assert by_key(report, "repo_id", *columns) == {
        1: (5, 1, 1.67, 0.6, "active_oss"), 2: (3, 0, 1.0, 0.33, "growing"),
        3: (1, 0, 0.33, 0.0, "early_release"), 5: (5, 0, 1.67, 0.0, "early_release"),
    }


def test_release_span_counts_calendar_days(spark, as_of):
    rows = [
        event("Release", at=datetime(2024, 1, 10, 23, 59)), event("Release", at=datetime(2024, 1, 11, 0, 1)),
        event("Push"),
    ]
    assert collected(mart_release_momentum(frame(spark, rows), as_of), "release_span_days") == [1]


def test_velocity_classes(spark, as_of):
    def stars(repo, days, n, name=None):
        return [event("Watch", repo=repo, name=name, at=days_ago(days)) for _ in range(n)]

    rows = [
        *stars(1, 1, 10), *stars(1, 2, 1),
        *stars(2, 1, 5), *stars(2, 8, 1),
        *stars(3, 1, 6), *stars(3, 3, 2),
        *stars(4, 1, 299), *stars(4, 4, 100),
        *stars(5, 1, 5), *stars(5, 9, 50), *stars(5, 0, 70),
        *stars(6, 1, 4),
        *stars(7, 1, 6), *stars(7, 2, 3), *stars(7, 6, 4),
        *stars(None, 1, 6, "x/y"), *stars(None, 2, 6, "x/y"),
        *stars(8, 1, 6, "a/new"), *stars(8, 3, 1, "a/old"), *stars(8, 3, 2, "a/new"),
    ]
    report = mart_viral_velocity(daily_signals(frame(spark, rows)), as_of)
    columns = [
        "stars_recent", "avg_daily_stars_7d", "total_stars_7d", "velocity_ratio",
        "stars_above_baseline", "velocity_class", "no_prior_baseline",
    ]
    assert by_key(report, "repo_id", *columns) == {
        1: (10, 1.0, 1, 10.0, 9.0, "explosive", False),
        2: (5, 1.0, 1, 5.0, 4.0, "viral", False),
        3: (6, 2.0, 2, 3.0, 4.0, "accelerating", False),
        4: (299, 100.0, 100, 2.99, 199.0, "steady", False),
        5: (5, 0.0, 0, None, 5.0, "steady", True),
        7: (6, 3.5, 7, 1.71, 3.0, "steady", False),
        None: (6, 0.0, 0, None, 6.0, "steady", True),
        8: (6, 1.5, 3, 4.0, 5.0, "accelerating", False),
    }
