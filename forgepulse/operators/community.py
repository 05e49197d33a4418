"""Reports built on the events of a repository, an organisation or a contributor.

Those of 90 days take events, or the counts that `activity.pairs_since` merges from days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse import rules
from forgepulse.clock import AsOf
from forgepulse.functions.events import (
    first_reached, hour_start, is_type, owner_of, per, recent_counts, since, with_event_date,
)
from forgepulse.functions.ranking import with_rank
from forgepulse.operators.activity import star_totals
from forgepulse.operators.profiles import distinct_pairs, without_bots
from forgepulse.sources.storage import Scratch


def hourly_ratios(hours: DataFrame) -> DataFrame:
    actors = F.col("unique_actors")
    return hours.withColumns({
        "events_per_actor": F.round(per(F.col("event_count"), actors), 2),
        "repos_per_actor": F.round(per(F.col("unique_repos"), actors), 2),
    })


def hourly_activity(events: DataFrame) -> DataFrame:
    """Events, actors and repositories per hour and type; an hour depends on its events alone."""
    keys = ["activity_hour", "event_type"]
    hours = events.withColumn("activity_hour", hour_start("created_at"))
    pairs = distinct_pairs(hours, keys, "actor_id", "repo_id", n_events=F.count("*"))
    return hourly_ratios(pairs.groupBy(*keys).agg(
        F.sum(F.when(F.col("of_first"), F.col("n_events"))).alias("event_count"),
        F.count_if(F.col("of_first") & F.col("actor_id").isNotNull()).alias("unique_actors"),
        F.count_if(~F.col("of_first") & F.col("repo_id").isNotNull()).alias("unique_repos"),
    ))


def mart_ecosystem_hourly(events: DataFrame, as_of: AsOf) -> DataFrame:
    """The hourly activity of the last seven days."""
    return hourly_activity(since(with_event_date(events), as_of, rules.HOURLY_DAYS))


def mart_org_scoreboard(orgs: DataFrame) -> DataFrame:
    """Organisations with two or more active repositories, ranked by events."""
    total = F.col("total_events")
    ranked = with_rank(
        orgs.where(F.col("repos_active") >= rules.MIN_ORG_REPOS), "total_events", "activity_rank"
    )
    return ranked.withColumns({
        "push_ratio": F.round(per(F.col("push_events"), total), 3),
        "pr_ratio": F.round(per(F.col("pr_events"), total), 3),
        "contributors_per_repo": F.round(per(F.col("unique_contributors"), F.col("repos_active")), 2),
        "org_tier": first_reached(F.col("unique_contributors"), rules.ORG_TIERS),
    })


def mart_contributor_migration(events: DataFrame, profiles: DataFrame, as_of: AsOf) -> DataFrame:
    """Contributors active in two or more organisations, with their profiles.

    Profiles are per login but attached by contributor alone: one with several
    logins gets a row for each profile.
    """
    recent = recent_counts(events, as_of, rules.CONTRIBUTOR_DAYS)
    in_orgs = (
        without_bots(recent)
        .where(F.col("org_id").isNotNull() & is_type(rules.PUSH, rules.PULL_REQUEST, rules.ISSUES))
        .groupBy("actor_id", "actor_login", "org_login")
        .agg(F.sum("n").alias("events"))
    )
    # One row per organisation by now, so the plain count and list are distinct.
    movers = (
        in_orgs.groupBy("actor_id", "actor_login")
        .agg(
            F.count("org_login").alias("org_count"),
            F.sort_array(F.collect_list("org_login")).alias("orgs"),
            F.sum("events").alias("total_cross_org_events"),
        )
        .where(F.col("org_count") >= rules.MIN_ORGS)
    )
    attached = profiles.select("actor_id", "repos_contributed_to", "contributor_type", "active_days")
    return movers.join(attached, "actor_id", "left")


def repo_totals(
    events: DataFrame, named: str, others: dict[str, str], actors_of: dict[str, str]
) -> DataFrame:
    """Per repository and name the events of type `named`; per repository those of other types.

    `others` maps a column to the type it counts, `actors_of` a column to the type
    whose distinct actors it counts. One scan serves all types. Its first shuffle is
    by (repository, type, name, actor), so a hot repository is spread and reaches
    the per-repository step as a row per type and name.
    """
    pairs = (
        events.where(is_type(named, *others.values()))
        .groupBy(
            "repo_id", "event_type",
            F.when(is_type(named), F.col("repo_name")).alias("repo_name"),
            F.when(is_type(named, *actors_of.values()), F.col("actor_id")).alias("actor_id"),
        )
        .agg(
            F.sum("n").alias("events"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("latest_at"),
        )
    )
    totals = pairs.groupBy("repo_id", "event_type", "repo_name").agg(
        F.sum("events").alias("events"),
        F.count("actor_id").alias("actors"),
        F.min("first_at").alias("first_at"),
        F.max("latest_at").alias("latest_at"),
    )
    # Without a repository id nothing can be attached; the name spreads such rows.
    known = F.col("repo_id").isNotNull()
    repo = Window.partitionBy("repo_id", F.when(~known, F.col("repo_name")))

    def attached(column: str, event_type: str) -> Column:
        of_repo = F.max(F.when(known & is_type(event_type), F.col(column))).over(repo)
        return F.coalesce(of_repo, F.lit(0))

    return (
        totals.where(known | is_type(named))
        .withColumns(
            {name: attached("events", event_type) for name, event_type in others.items()}
            | {name: attached("actors", event_type) for name, event_type in actors_of.items()}
        )
        .where(is_type(named))
        .withColumn("owner", owner_of("repo_name"))
        .drop("event_type")
    )


def mart_fork_conversion(
    events: DataFrame, signals: DataFrame, as_of: AsOf, scratch: Scratch | None = None
) -> DataFrame:
    """Repositories forked at least twice in 90 days and the pull requests that followed.

    Stars count over all history, and come from the daily table rather than the events; only
    those of repositories in the report are totalled.
    """
    totals = repo_totals(
        recent_counts(events, as_of, rules.COMMUNITY_DAYS),
        named=rules.FORK,
        others={"pr_count": rules.PULL_REQUEST},
        actors_of={"unique_pr_authors": rules.PULL_REQUEST},
    )
    forks, requests = F.col("fork_count"), F.col("pr_count")
    conversion = per(requests, forks)
    # Labels and bounds, tested in this order.
    health = (
        F.when(conversion >= 0.5, "thriving")
        .when(requests > 0, "growing")
        .when(forks >= 3, "fork_graveyard")
        .otherwise("early_stage")
    )
    # Read twice; few repositories are left, so the planner can broadcast their ids.
    forked = (scratch or Scratch(events.sparkSession)).keep(
        totals.withColumnsRenamed({"events": "fork_count", "actors": "unique_forkers"})
        .where(forks >= rules.MIN_FORKS)
    )
    of_forked = signals.select("repo_id", "stars").join(
        forked.select("repo_id").distinct(), "repo_id", "left_semi"
    )
    return (
        forked.join(star_totals(of_forked), "repo_id", "left")
        .fillna(0, subset=["star_count"])
        .withColumns({"fork_to_pr_conversion": F.round(conversion, 3), "community_health": health})
        .drop("first_at", "latest_at")
    )


def mart_release_momentum(events: DataFrame, as_of: AsOf) -> DataFrame:
    """Repositories with releases and pushes in 90 days, and how they sustain them."""
    totals = repo_totals(
        recent_counts(events, as_of, rules.COMMUNITY_DAYS),
        named=rules.RELEASE,
        others={
            "pr_count": rules.PULL_REQUEST, "push_count": rules.PUSH, "star_count": rules.WATCH,
        },
        actors_of={"unique_pr_authors": rules.PULL_REQUEST, "unique_pushers": rules.PUSH},
    )
    releases, requests = F.col("release_count"), F.col("pr_count")
    # Labels and bounds, tested in this order.
    stage = (
        F.when((releases >= 5) & (F.col("unique_pr_authors") >= 3), "active_oss")
        .when((releases >= 3) & (requests > 0), "growing")
        .when((releases >= 1) & (F.col("push_count") > 0), "early_release")
        .otherwise("solo_project")
    )
    span = F.date_diff(F.to_date("latest_release_at"), F.to_date("first_release_at"))
    return (
        totals.withColumnsRenamed({
            "events": "release_count", "actors": "unique_releasers",
            "first_at": "first_release_at", "latest_at": "latest_release_at",
        })
        .where(F.col("push_count") > 0)
        .withColumns({
            "release_span_days": span.cast("bigint"),
            "releases_per_30_days": F.round(releases * F.lit(30.0) / F.lit(rules.COMMUNITY_DAYS), 2),
            "prs_per_release": F.round(per(requests, releases), 2),
            "project_stage": stage,
        })
    )


def mart_viral_velocity(signals: DataFrame, as_of: AsOf) -> DataFrame:
    """Yesterday's stars of a repository against its seven days before, from daily counts.

    The baseline averages over the (name, day) rows that have stars, and is rounded
    before it is compared. Only days that can count are read.
    """
    yesterday, oldest = as_of.day(1), as_of.day(8)
    stars = signals.where(
        (F.col("stars") > 0) & F.col("activity_date").between(F.lit(oldest), F.lit(yesterday))
    )
    is_recent = F.col("activity_date") == F.lit(yesterday)
    # One bit per day of the baseline, seven at most, counts its days without a distinct count.
    day_bit = F.call_function("shiftleft", F.lit(1), F.date_diff(F.lit(yesterday), "activity_date"))
    by_name = stars.groupBy("repo_id", "repo_name").agg(
        F.sum(F.when(is_recent, F.col("stars")).otherwise(F.lit(0))).alias("stars_recent"),
        F.sum(F.when(~is_recent, F.col("stars")).otherwise(F.lit(0))).alias("_stars"),
        F.bit_count(F.bit_or(F.when(~is_recent, day_bit))).alias("_days"),
    )
    # Without a repository id there is no baseline; the name spreads such rows.
    known = F.col("repo_id").isNotNull()
    repo = Window.partitionBy("repo_id", F.when(~known, F.col("repo_name")))
    with_baseline = by_name.withColumns({
        "_total": F.sum(F.when(known & (F.col("_stars") > 0), F.col("_stars"))).over(repo),
        "_rows": F.sum("_days").over(repo),
    }).where(F.col("stars_recent") >= rules.MIN_RECENT_STARS)
    baseline = F.round(per(F.col("_total"), F.col("_rows")), 2)
    ratio = per(F.col("stars_recent"), F.col("_baseline"))
    average = F.coalesce("_baseline", F.lit(0.0))
    return (
        with_baseline.withColumn("_baseline", baseline)
        .select(
            "repo_id", "repo_name", owner_of("repo_name").alias("owner"), "stars_recent",
            average.alias("avg_daily_stars_7d"),
            F.coalesce("_total", F.lit(0)).alias("total_stars_7d"),
            F.round(ratio, 2).alias("velocity_ratio"),
            F.round(F.col("stars_recent") - average, 0).alias("stars_above_baseline"),
            first_reached(ratio, rules.VELOCITY_CLASSES).alias("velocity_class"),
            F.col("_baseline").isNull().alias("no_prior_baseline"),
        )
    )
