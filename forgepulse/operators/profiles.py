"""Profiles of contributors and organisations.

Both need distinct counts over two different columns. Spark's own plan for that
copies each row once per distinct expression (six here); grouping sets copy it
twice, reduce the copies to one row per pair before the shuffle, and are shuffled
by the pair, so a hot contributor or organisation is spread over all tasks.

Both take events, or the counts of a window that `activity.pairs_since` merges from days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse import rules
from forgepulse.clock import AsOf
from forgepulse.functions.events import count_of, is_type, recent_counts


def distinct_pairs(
    events: DataFrame, keys: list[str], first: str, second: str, **aggregates: Column
) -> DataFrame:
    """One row per (keys, first) and one per (keys, second), told apart by `of_first`."""
    return (
        events.groupingSets([[*keys, first], [*keys, second]], *keys, first, second)
        .agg(F.grouping_id().alias("_set"), *[agg.alias(name) for name, agg in aggregates.items()])
        # The set without `second` has its bit, the lowest one, raised.
        .withColumn("of_first", F.col("_set").bitwiseAND(1) == 1)
        .drop("_set")
    )


def any_of(*types: str) -> Column:
    return F.max(is_type(*types))


def without_bots(events: DataFrame) -> DataFrame:
    """Drops logins with a bot mark, and rows without a login."""
    return events.where(~F.col("actor_login").contains(rules.BOT_TEXT))


def int_contributor_profiles(events: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per contributor and login of the last 90 days, bots left out."""
    keys = ["actor_id", "actor_login"]
    recent = recent_counts(events, as_of, rules.CONTRIBUTOR_DAYS)
    people = without_bots(recent).where(~F.col("actor_login").endswith(rules.BOT_SUFFIX))
    pairs = distinct_pairs(
        people, keys, "repo_id", "event_date",
        n_events=F.sum("n"),
        first_seen=F.min("first_at"),
        last_seen=F.max("last_at"),
        pushed=any_of(rules.PUSH),
        requested=any_of(rules.PULL_REQUEST),
        discussed=any_of(rules.ISSUES),
        starred=any_of(rules.WATCH),
    )
    a_repo = F.col("of_first") & F.col("repo_id").isNotNull()
    built = F.col("pushed") | F.col("requested")
    totals = pairs.groupBy(*keys).agg(
        F.count_if(a_repo).alias("repos_contributed_to"),
        F.count_if(a_repo & F.col("pushed")).alias("repos_pushed_to"),
        F.count_if(a_repo & F.col("requested")).alias("repos_pr_to"),
        F.count_if(a_repo & F.col("discussed")).alias("repos_issues_on"),
        F.count_if(a_repo & F.col("starred")).alias("repos_starred"),
        F.sum(F.when(F.col("of_first"), F.col("n_events"))).alias("total_events"),
        F.count_if(~F.col("of_first")).alias("active_days"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.count_if(a_repo & built).alias("_repos_built"),
    )
    # Labels and bounds, tested in this order.
    contributor_type = (
        F.when(F.col("_repos_built") >= 5, "polyglot_contributor")
        .when((F.col("repos_starred") >= 10) & (F.col("repos_pushed_to") == 0), "scout")
        .when(F.col("_repos_built") >= 2, "active_contributor")
        .otherwise("casual")
    )
    return totals.withColumn("contributor_type", contributor_type).drop("_repos_built")


def int_org_activity(events: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per organisation and login of the last 30 days."""
    keys = ["org_id", "org_login"]
    recent = recent_counts(events, as_of, rules.ORG_DAYS).dropna(subset=keys)
    types = {
        "push_events": rules.PUSH,
        "pr_events": rules.PULL_REQUEST,
        "release_events": rules.RELEASE,
        "star_events": rules.WATCH,
    }
    pairs = distinct_pairs(
        recent, keys, "actor_id", "repo_id",
        total_events=F.sum("n"),
        first_activity=F.min("first_at"),
        last_activity=F.max("last_at"),
        **{name: count_of(event_type) for name, event_type in types.items()},
    )
    an_actor = F.col("of_first") & F.col("actor_id").isNotNull()
    a_repo = ~F.col("of_first") & F.col("repo_id").isNotNull()
    return pairs.groupBy(*keys).agg(
        F.count_if(a_repo).alias("repos_active"),
        F.count_if(an_actor).alias("unique_contributors"),
        F.count_if(an_actor & (F.col("push_events") > 0)).alias("unique_pushers"),
        F.count_if(an_actor & (F.col("pr_events") > 0)).alias("unique_pr_authors"),
        *[
            F.sum(F.when(F.col("of_first"), F.col(name))).alias(name)
            for name in ["total_events", *types]
        ],
        F.min("first_activity").alias("first_activity"),
        F.max("last_activity").alias("last_activity"),
    )
