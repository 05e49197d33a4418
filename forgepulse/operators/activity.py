"""Daily repository activity, the table most reports start from."""

from __future__ import annotations

from datetime import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse import rules
from forgepulse.clock import AsOf
from forgepulse.functions.events import counted, is_type, owner_of, since, with_event_date
from forgepulse.sources.storage import Scratch

DAY = ["repo_id", "activity_date"]

# Signals that stem from one event type and are therefore present or absent together.
SIGNAL_GROUPS = [["stars"], ["pushes", "unique_pushers"], ["forks"], ["pull_requests"], ["issues"]]
SIGNALS = [name for group in SIGNAL_GROUPS for name in group]


def _has_day_key() -> Column:
    return F.col("repo_id").isNotNull() & F.col("activity_date").isNotNull()


def daily_signals(events: DataFrame) -> DataFrame:
    """Plain counts per repository, name and day, from one scan of the events.

    Only one distinct count, so no row is multiplied; its first shuffle is by
    (repository, name, day, pusher), which spreads a hot repository. `renamed` marks
    the days on which a repository went by several names.

    A day depends on that day's events alone: pass some days' events to rebuild them.
    """
    # Rows without a repository or day are nobody's other name; the name spreads them.
    same_day = Window.partitionBy(*DAY, F.when(~_has_day_key(), F.col("repo_name")))
    return (
        with_event_date(events)
        .groupBy("repo_id", "repo_name", F.col("event_date").alias("activity_date"))
        .agg(
            F.count_if(is_type(rules.WATCH)).alias("stars"),
            F.count_if(is_type(rules.PUSH)).alias("pushes"),
            F.count_distinct(F.when(is_type(rules.PUSH), F.col("actor_id"))).alias("unique_pushers"),
            F.count_if(is_type(rules.FORK)).alias("forks"),
            F.count_if(is_type(rules.PULL_REQUEST)).alias("pull_requests"),
            F.count_if(is_type(rules.ISSUES)).alias("issues"),
            F.count_if(is_type(rules.CREATE)).alias("creations"),
        )
        .withColumn("renamed", F.count("*").over(same_day) > 1)
    )


PAIR = ["event_type", "actor_id", "actor_login", "repo_id", "repo_name", "org_id", "org_login"]


def daily_pairs(events: DataFrame) -> DataFrame:
    """Per day each contributor's events of a type on a repository: how many, first and last.

    Distinct counts cannot be merged, but the pairs they count can: a report over a window
    reads its days' pairs instead of its events. A day depends on that day's events alone.
    """
    rows = counted(with_event_date(events))
    return rows.groupBy(F.col("event_date").alias("activity_date"), *PAIR).agg(
        F.sum("n").alias("n"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
    )


def pairs_since(pairs: DataFrame, events: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """The counts of the last `days` days, with no upper bound: whole days from the stored
    pairs, and the window's first day, if it starts within one, from that day's events."""
    edge = as_of.date_ago(days)
    at_midnight = as_of.at.time() == time.min
    whole = F.col("activity_date") >= edge if at_midnight else F.col("activity_date") > edge
    merged = pairs.where(whole).withColumnRenamed("activity_date", "event_date")
    if at_midnight:
        return merged
    first_day = since(events.where(F.col("event_date") == edge), as_of, days)
    return merged.unionByName(
        daily_pairs(first_day).withColumnRenamed("activity_date", "event_date").select(*merged.columns)
    )


def star_totals(signals: DataFrame) -> DataFrame:
    """All stars a repository ever got, whatever its name."""
    return signals.groupBy("repo_id").agg(F.sum("stars").alias("star_count"))


def first_creations(signals: DataFrame) -> DataFrame:
    """The day each repository was first created under each name."""
    return signals.where(F.col("creations") > 0).groupBy("repo_id", "repo_name").agg(
        F.min("activity_date").alias("first_seen_date")
    )


def _signals_of_all_names(renamed: DataFrame) -> DataFrame:
    """Each name of a repository's day with the signals recorded under any of its names."""
    rows = renamed.select("repo_id", "repo_name", "activity_date")
    for group in SIGNAL_GROUPS:
        recorded = renamed.where(F.col(group[0]) > 0).select(*DAY, *group)
        rows = rows.join(recorded, DAY, "left")
    return rows.fillna(0, subset=SIGNALS)


def int_repo_daily_activity(signals: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per repository, name and day with its signals and activity score.

    Signals are attached by repository and day, whatever the name. On a day on
    which a repository went by several names, each name therefore gets one row per
    combination of the names its signals were recorded under. Under one name, which
    is nearly always the case, the row is simply the day's counts. So the joins run
    over the renamed days only, which are kept apart.

    `signals` is read twice; pass a stored table or a kept result.
    """
    scratch = scratch or Scratch(signals.sparkSession)
    # Signals cannot be attached to a missing key, so such rows count nothing.
    single = signals.where(~F.col("renamed")).select(
        "repo_id", "repo_name", "activity_date",
        *[F.when(_has_day_key(), F.col(name)).otherwise(F.lit(0)).alias(name) for name in SIGNALS],
    )
    renamed = scratch.keep(signals.where("renamed").select("repo_name", *DAY, *SIGNALS))
    rows = single.unionByName(_signals_of_all_names(renamed))
    score = sum(
        (F.col(name) * F.lit(weight) for name, weight in rules.SCORE_WEIGHTS.items()), F.lit(0.0)
    )
    return rows.select(
        "repo_id", "repo_name", "activity_date", owner_of("repo_name").alias("owner"),
        *SIGNALS, score.alias("activity_score"),
    )


def activity_of_events(events: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Daily activity straight from events."""
    scratch = scratch or Scratch(events.sparkSession)
    return int_repo_daily_activity(scratch.keep(daily_signals(events)), scratch)
