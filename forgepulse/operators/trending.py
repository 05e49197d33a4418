"""Reports built on the daily activity table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse import rules
from forgepulse.clock import AsOf
from forgepulse.functions.events import owner_of, per
from forgepulse.functions.ranking import with_rank
from forgepulse.operators.activity import first_creations


def mart_trending_repos(activity: DataFrame, as_of: AsOf) -> DataFrame:
    """Scored repository days of the last 30 days, ranked within their day."""
    scored = activity.where(
        (F.col("activity_date") >= as_of.date_ago(rules.TRENDING_DAYS))
        & (F.col("activity_score") > 0)
        & ~F.col("owner").isin(rules.EXCLUDED_OWNERS)
        & ~F.col("repo_name").contains(rules.EXCLUDED_REPO_TEXT)
    )

    def per_star(signal: str) -> Column:
        return F.coalesce(F.round(per(F.col(signal), F.col("stars")), 3), F.lit(0.0))

    return with_rank(scored, "activity_score", "daily_rank", by=["activity_date"]).withColumns({
        "fork_to_star_ratio": per_star("forks"),
        "pr_to_star_ratio": per_star("pull_requests"),
        "has_community_contributors": F.col("unique_pushers") > 1,
    })


def mart_trending_by_topic(trending: DataFrame, metadata: DataFrame) -> DataFrame:
    """Trending repositories with their metadata and two texts to search in.

    The join carries no broadcast hint: the metadata grow with the number of
    enriched repositories, and the planner knows their size.
    """
    described = metadata.select(
        "repo_id",
        F.col("description").alias("repo_description"),
        F.col("language").alias("primary_language"),
        F.col("topics").alias("topic_tags"),
        "license",
        F.col("stargazers_count").alias("total_stars"),
        F.col("forks_count").alias("total_forks"),
        "owner_type",
        "is_fork",
        F.col("created_at").alias("repo_created_at"),
    )

    def or_empty(text: Column) -> Column:
        return F.coalesce(text, F.lit(""))

    return trending.join(described, "repo_id", "left").withColumns({
        "topics_flat": or_empty(F.array_join("topic_tags", ",")),
        "search_text": F.lower(F.concat_ws(
            " ",
            or_empty(F.array_join("topic_tags", " ")),
            or_empty(F.col("repo_description")),
            or_empty(F.col("primary_language")),
        )),
    })


def _mentions(text: str, fragments: list[str]) -> Column:
    return F.lower(text).rlike("|".join(fragments))


def mart_ai_ecosystem(by_topic: DataFrame, as_of: AsOf) -> DataFrame:
    """AI repositories with their activity of this week against the week before.

    Both weeks come from one pass. The week before counts per repository, whatever
    its name and metadata, hence the sum over the repository's few rows. Without
    metadata a repository cannot qualify, which lets the planner turn the metadata
    join into an inner join with AI repositories only.
    """
    qualifies = _mentions("topics_flat", rules.AI_TOPICS) | (
        (F.col("primary_language") == rules.AI_TEXT_LANGUAGE) & _mentions("search_text", rules.AI_TEXT)
    )
    # Eight dates against seven: this week includes both of its ends.
    this_week = F.col("activity_date") >= as_of.date_ago(7)
    last_week = F.col("activity_date").between(as_of.date_ago(14), as_of.date_ago(8))
    repo = [
        "repo_id", "repo_name", "owner", "primary_language", "topic_tags",
        "repo_description", "total_stars", "total_forks",
    ]

    def this(signal: str) -> Column:
        return F.sum(F.when(this_week, F.col(signal)))

    def last(signal: str) -> Column:
        return F.sum(F.when(last_week, F.col(signal)))

    weeks = (
        by_topic.where(qualifies & (F.col("activity_date") >= as_of.date_ago(14)))
        # topics_flat follows from topic_tags, so grouping by it as well changes nothing.
        .groupBy(*repo)
        .agg(
            this("stars").alias("stars_this_week"),
            this("pushes").alias("pushes_this_week"),
            this("forks").alias("forks_this_week"),
            this("pull_requests").alias("prs_this_week"),
            this("activity_score").alias("score_this_week"),
            F.min(F.when(this_week, F.col("daily_rank"))).alias("best_daily_rank"),
            last("stars").alias("_stars"),
            last("activity_score").alias("_score"),
        )
    )
    whole_repo = Window.partitionBy("repo_id")
    ratio = per(F.col("score_this_week"), F.col("_score_before"))
    momentum = F.when(F.col("_score_before").isNull(), rules.MOMENTUM_NO_LAST_WEEK).otherwise(
        rules.MOMENTUM_OTHERWISE
    )
    for label, bound in reversed(rules.MOMENTUM):
        momentum = F.when(ratio >= bound, label).otherwise(momentum)
    return (
        weeks.withColumns({
            "_stars_before": F.sum("_stars").over(whole_repo),
            "_score_before": F.sum("_score").over(whole_repo),
        })
        .where(F.col("score_this_week").isNotNull())
        .withColumns({
            "stars_last_week": F.coalesce("_stars_before", F.lit(0)),
            "score_last_week": F.coalesce("_score_before", F.lit(0.0)),
            "score_wow_ratio": F.round(ratio, 2),
            "momentum": momentum,
        })
        .withColumn("star_wow_delta", F.col("stars_this_week") - F.col("stars_last_week"))
        .drop("_stars", "_score", "_stars_before", "_score_before")
    )


def mart_new_repo_breakout(signals: DataFrame, activity: DataFrame, as_of: AsOf) -> DataFrame:
    """Repositories first created in the last 30 days, with all activity they ever had.

    Both inputs hold all history, so the daily tables are read, never the events.
    """
    created = (
        first_creations(signals)
        .where(F.col("first_seen_date") >= as_of.date_ago(rules.NEW_REPO_DAYS))
        .withColumn("owner", owner_of("repo_name"))
        .where(~F.col("owner").isin(rules.EXCLUDED_OWNERS))
    )
    totals = (
        # Only the newborn repositories' days are added up.
        activity.join(created.select("repo_id"), "repo_id", "left_semi").groupBy("repo_id")
        .agg(
            F.sum("stars").alias("total_stars"),
            F.sum("pushes").alias("total_pushes"),
            F.sum("forks").alias("total_forks"),
            F.sum("pull_requests").alias("total_prs"),
            F.sum("issues").alias("total_issues"),
            F.sum("activity_score").alias("total_activity_score"),
            F.max("activity_score").alias("peak_daily_score"),
            F.count("*").alias("active_days"),
        )
        .where(F.col("total_activity_score") > 0)
    )
    age, stars = F.col("age_days"), F.col("total_stars")
    tier = F.lit(rules.BREAKOUT_OTHERWISE)
    for label, least_stars, greatest_age in reversed(rules.BREAKOUT_TIERS):
        tier = F.when((stars >= least_stars) & (age <= greatest_age), label).otherwise(tier)
    return (
        created.join(totals, "repo_id")
        .withColumn("age_days", F.date_diff(as_of.date_ago(), "first_seen_date").cast("bigint"))
        .withColumns({
            "stars_per_day": F.round(per(stars, age), 2),
            "activity_per_day": F.round(per(F.col("total_activity_score"), age), 2),
            "breakout_tier": tier,
        })
    )
