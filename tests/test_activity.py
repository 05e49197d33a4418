"""Daily activity and the trending ranks built on it."""

from __future__ import annotations

from functools import reduce

from conftest import by_key, collected, days_ago, event, frame, metadata
from pyspark.sql import functions as F

from forgepulse import binding, rules
from forgepulse.operators.activity import (
    DAY, SIGNALS, activity_of_events, daily_signals, int_repo_daily_activity,
)
from forgepulse.operators.staging import VIEW_COLUMNS, VIEWS, staging_views
from forgepulse.operators.trending import (
    mart_ai_ecosystem, mart_new_repo_breakout, mart_trending_by_topic, mart_trending_repos,
)

DATA = "/root/testdata/sf0.001"


def literal_activity(events):
    """Daily activity by its definition: one aggregate per type, joined by repository and day."""
    names = ["repo_id", "repo_name", "activity_date"]
    dated = events.withColumn("activity_date", F.to_date("created_at"))
    kinds = {
        rules.WATCH: [F.count("*").alias("stars")],
        rules.PUSH: [F.count("*").alias("pushes"), F.count_distinct("actor_id").alias("unique_pushers")],
        rules.FORK: [F.count("*").alias("forks")],
        rules.PULL_REQUEST: [F.count("*").alias("pull_requests")],
        rules.ISSUES: [F.count("*").alias("issues")],
    }
    daily = [
        dated.where(F.col("event_type") == kind).groupBy(*names).agg(*counts).drop("repo_name")
        for kind, counts in kinds.items()
    ]
    spine = dated.select(*names).distinct()
    return reduce(lambda left, right: left.join(right, DAY, "left"), daily, spine).fillna(0, SIGNALS)


def test_score_adds_up_weighted_signals(spark):
    rows = [event(kind, at=days_ago(1)) for kind in ("Watch", "Fork", "PullRequest", "Issues", "Push", "Push")]
    row = activity_of_events(frame(spark, rows)).first()
    assert (row.stars, row.forks, row.pull_requests, row.issues) == (1, 1, 1, 1)
    assert (row.pushes, row.unique_pushers, row.activity_score, row.owner) == (2, 1, 10.0, "own")


def test_other_events_give_an_empty_day_that_never_trends(spark, as_of):
    activity = activity_of_events(frame(spark, [event("IssueComment")]))
    assert collected(activity, *SIGNALS, "activity_score") == [(0, 0, 0, 0, 0, 0, 0.0)]
    assert mart_trending_repos(activity, as_of).count() == 0


def test_rename_within_a_day_combines_all_names(spark):
    rows = [event("Watch", name="a/old"), event("Watch", name="a/new"), event("Watch", name="a/new")]
    activity = activity_of_events(frame(spark, rows))
    assert collected(activity, "repo_name", "stars") == [
        ("a/new", 1), ("a/new", 2), ("a/old", 1), ("a/old", 2),
    ]


def test_rename_signals_of_one_name_reach_the_other(spark):
    rows = [event("Watch", name="a/old"), event("Push", name="a/new", actor=5)]
    activity = activity_of_events(frame(spark, rows))
    assert collected(activity, "repo_name", "stars", "pushes", "unique_pushers") == [
        ("a/new", 1, 1, 1), ("a/old", 1, 1, 1),
    ]


def test_missing_repository_ids_count_nothing(spark):
    rows = [event("Watch", repo=None, name=f"x/{n}") for n in range(3)]
    assert collected(activity_of_events(frame(spark, rows)), "repo_name", "stars") == [
        ("x/0", 0), ("x/1", 0), ("x/2", 0),
    ]


def test_missing_day_counts_nothing(spark):
    row = event("Watch") | {"created_at": None, "event_date": None}
    assert collected(activity_of_events(frame(spark, [row])), "activity_date", "stars") == [(None, 0)]


def test_equals_the_literal_joins(spark):
    events = binding.bound_events(spark, DATA)
    columns = ["repo_id", "repo_name", "activity_date", *SIGNALS]
    ours = activity_of_events(events).select(*columns)
    literal = literal_activity(events).select(*columns)
    assert ours.count() == literal.count()
    assert ours.exceptAll(literal).isEmpty()


def test_order_of_rows_does_not_matter(spark):
    events = binding.bound_events(spark, DATA)
    shuffled = events.repartition(7, F.rand(3))
    assert activity_of_events(shuffled).exceptAll(activity_of_events(events)).isEmpty()


def test_days_can_be_built_apart(spark):
    events = binding.bound_events(spark, DATA)
    cut = F.col("event_date") < "2024-01-15"
    apart = activity_of_events(events.where(cut)).unionByName(
        activity_of_events(events.where(~cut))
    )
    assert apart.exceptAll(activity_of_events(events)).isEmpty()
    assert apart.count() == activity_of_events(events).count()


def test_staging_views_filter_by_type(spark):
    views = staging_views(frame(spark, [event(kind[: -len("Event")]) for kind in VIEWS.values()]))
    assert len(views) == 7
    for view in views.values():
        assert view.columns == VIEW_COLUMNS and view.count() == 1


def test_equal_scores_share_a_rank(spark, as_of):
    rows = [event("Watch", repo=repo) for repo in (1, 2, 3, 3)] + [event("Issues", repo=4)]
    trending = mart_trending_repos(activity_of_events(frame(spark, rows)), as_of)
    assert by_key(trending, "repo_id", "daily_rank") == {3: (1,), 4: (2,), 1: (3,), 2: (3,)}


def test_trending_window_owners_and_ratios(spark, as_of):
    rows = [
        event("Watch", repo=1, at=days_ago(30)),
        event("Watch", repo=2, at=days_ago(31)),
        event("Watch", repo=3, name="github/x"),
        event("Watch", repo=4, name="dependabot/x"),
        event("Watch", repo=5, name="a/.github"),
        event("Watch", repo=10, at=days_ago(-1)),
        *[event("Fork", repo=6) for _ in range(3)],
        *[event("Watch", repo=7) for _ in range(3)],
        event("Fork", repo=7), event("PullRequest", repo=7), event("PullRequest", repo=7),
        event("Push", repo=8, actor=1), event("Push", repo=8, actor=2), event("Push", repo=9),
    ]
    trending = mart_trending_repos(activity_of_events(frame(spark, rows)), as_of)
    ratios = by_key(
        trending, "repo_id", "fork_to_star_ratio", "pr_to_star_ratio", "has_community_contributors"
    )
    assert ratios == {
        1: (0.0, 0.0, False), 6: (0.0, 0.0, False), 7: (0.333, 0.667, False),
        8: (0.0, 0.0, True), 9: (0.0, 0.0, False), 10: (0.0, 0.0, False),
    }


def _by_topic(spark, as_of, rows, *records):
    trending = mart_trending_repos(activity_of_events(frame(spark, rows)), as_of)
    return mart_trending_by_topic(trending, metadata(spark, *records))


def test_topic_texts_without_topics_or_metadata(spark, as_of):
    rows = [event("Watch", repo=repo) for repo in (1, 2, 3, 4)]
    by_topic = _by_topic(
        spark, as_of, rows,
        {"repo_id": 1, "topics": None, "description": "Some Text", "language": None},
        {"repo_id": 2, "topics": [], "language": "Rust"},
        {"repo_id": 4, "topics": ["A", "b"], "description": "D", "language": "Go"},
    )
    assert len(by_topic.columns) == 26
    assert by_key(by_topic, "repo_id", "topics_flat", "search_text") == {
        1: ("", " some text "), 2: ("", "  rust"), 3: ("", "  "), 4: ("A,b", "a b d go"),
    }


def test_ai_repositories_by_topic_or_python_text(spark, as_of):
    rows = [event("Watch", repo=repo) for repo in range(1, 8)]
    by_topic = _by_topic(
        spark, as_of, rows,
        {"repo_id": 1, "topics": ["storage"]},
        {"repo_id": 2, "description": "An AI Agent kit", "language": "Python"},
        {"repo_id": 3, "description": "An AI Agent kit", "language": "Rust"},
        {"repo_id": 4, "topics": ["cli"], "language": "Python"},
        {"repo_id": 5, "topics": ["My-LLM-tool"]},
        {"repo_id": 6, "description": "an ai agent", "language": None},
    )
    assert collected(mart_ai_ecosystem(by_topic, as_of), "repo_id") == [1, 2, 5]


def test_weeks_and_momentum(spark, as_of):
    def stars(repo, days, n):
        return [event("Watch", repo=repo, at=days_ago(days)) for _ in range(n)]

    rows = [
        *stars(1, 7, 3), *stars(1, 8, 1),
        *stars(2, 0, 3), *stars(2, 14, 2),
        *stars(3, 0, 149), *stars(3, 9, 100),
        *stars(4, 0, 2), *stars(4, 15, 9),
        *stars(5, 8, 2),
    ]
    by_topic = _by_topic(spark, as_of, rows, *[{"repo_id": n, "topics": ["llm"]} for n in range(1, 6)])
    report = by_key(
        mart_ai_ecosystem(by_topic, as_of), "repo_id", "stars_this_week", "stars_last_week",
        "star_wow_delta", "score_last_week", "score_wow_ratio", "momentum",
    )
    assert report == {
        1: (3, 1, 2, 1.0, 3.0, "surging"),
        2: (3, 2, 1, 2.0, 1.5, "growing"),
        3: (149, 100, 49, 100.0, 1.49, "stable"),
        4: (2, 0, 2, 0.0, None, "new_to_radar"),
    }


def test_last_week_counts_all_names_of_a_repository(spark, as_of):
    rows = [
        event("Watch", name="a/old", at=days_ago(10)),
        event("Watch", name="a/new", at=days_ago(9)), event("Watch", name="a/new", at=days_ago(2)),
    ]
    by_topic = _by_topic(spark, as_of, rows, {"repo_id": 1, "topics": ["llm"]})
    report = mart_ai_ecosystem(by_topic, as_of)
    assert collected(report, "repo_name", "stars_this_week", "stars_last_week") == [("a/new", 1, 2)]
    assert len(report.columns) == 19


def test_breakout_tiers(spark, as_of):
    def born(repo, age, n_stars, **other):
        return [event("Create", repo=repo, at=days_ago(age), **other)] + [
            event("Watch", repo=repo, at=days_ago(0), **other) for _ in range(n_stars)
        ]

    rows = [
        *born(1, 7, 500), *born(2, 14, 200), *born(3, 30, 50), *born(4, 1, 49), *born(5, 0, 2),
        *born(6, 31, 3), event("Create", repo=6, at=days_ago(1)),
        *born(7, 3, 0), *born(8, 3, 5, name="github/new"), *born(9, 8, 500),
    ]
    events = frame(spark, rows)
    signals = daily_signals(events)
    report = mart_new_repo_breakout(signals, int_repo_daily_activity(signals), as_of)
    assert by_key(report, "repo_id", "age_days", "total_stars", "stars_per_day", "breakout_tier") == {
        1: (7, 500, 71.43, "instant_hit"), 2: (14, 200, 14.29, "fast_mover"),
        3: (30, 50, 1.67, "rising"), 4: (1, 49, 49.0, "early_stage"), 5: (0, 2, None, "early_stage"),
        9: (8, 500, 62.5, "fast_mover"),
    }
    ages = by_key(report, "repo_id", "active_days", "peak_daily_score", "activity_per_day")
    assert ages[1] == (2, 500.0, 71.43) and ages[5] == (1, 2.0, None)
