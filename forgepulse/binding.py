"""The supplied test tables read as the tables the models expect.

Events come from `events`, repository metadata from `part`. About 42 popular
repositories take most events; a fifth goes to small ones, three users sharing ten,
so that repositories and organisations grow with the data. The rules also provide
what the models must handle: late events, renames, bots, a spike on the last day, a
newborn repository, and missing ids and logins. Every seventh repository id has no
metadata.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.clock import AsOf
from forgepulse.functions.events import hour_key
from forgepulse.schema import EVENTS, METADATA
from forgepulse.sources.storage import Scratch
from forgepulse.sources.warehouse import arranged

AS_OF = AsOf(datetime(2024, 1, 31))


def _case(*branches: tuple, otherwise):
    condition, value = branches[0]
    case = F.when(condition, value)
    for condition, value in branches[1:]:
        case = case.when(condition, value)
    return case.otherwise(otherwise)


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def bound_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, kind, ts = F.col("user_id"), F.col("event_type"), F.col("ts")
    k, cents, repo = F.col("k"), F.col("cents"), F.col("repo_id")
    user_text = user.cast("string")
    nothing = F.lit(None)
    tail = cents.isin(5, 6)
    popular = F.least(F.floor(k * k / 245.0), F.lit(39))
    team = F.floor(user / 3)

    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (F.round(F.col("value") * 100).cast("bigint") % 10).alias("cents"),
    )
    with_repo = raw.withColumn("repo_id", _case(
        ((ts >= _time("2024-01-30 00:00:00")) & (k >= 70), F.lit(41)),
        ((ts >= _time("2024-01-26 00:00:00")) & k.between(60, 69), F.lit(40)),
        (k == 98, F.lit(41)),
        (tail & (k == 97), nothing),
        (tail, 50 + team * 10 + k % 10),
        (user % 10 == 2, popular % 3),
        otherwise=popular,
    ).cast("bigint"))
    days_late = _case(
        (repo >= 20, F.lit(0)), (cents == 7, F.lit(30)), (cents == 8, F.lit(60)),
        (cents == 9, F.lit(90)), otherwise=F.lit(0),
    )
    with_org = with_repo.withColumns({
        "created_at": ts - F.make_dt_interval(days_late),
        "org_id": _case(
            ((repo >= 50) & (team % 2 == 1), nothing),
            (repo >= 50, 100 + F.floor(user / 12)),
            (repo % 4 == 3, nothing),
            (repo == 38, F.lit(99)),
            otherwise=repo % 6,
        ).cast("bigint"),
    })
    org_text = F.concat(F.lit("org-"), F.col("org_id").cast("string"))
    repo_text = repo.cast("string")
    return with_org.select(
        "event_id",
        _case(
            (user % 10 == 0, "WatchEvent"),
            (user % 10 == 1, "IssuesEvent"),
            (kind == "view", "WatchEvent"),
            (kind == "click", "PushEvent"),
            (kind == "purchase", "PullRequestEvent"),
            ((kind == "signup") & (F.col("event_id") % 2 == 0), "ForkEvent"),
            (kind == "signup", "IssuesEvent"),
            (F.col("event_id") % 4 == 0, "ReleaseEvent"),
            (F.col("event_id") % 4 == 1, "CreateEvent"),
            (F.col("event_id") % 4 == 2, "WatchEvent"),
            otherwise="IssueCommentEvent",
        ).alias("event_type"),
        user.alias("actor_id"),
        _case(
            ((cents == 6) & (k == 4), nothing),
            (user % 29 == 0, F.concat(F.lit("app-"), user_text, F.lit("[bot]"))),
            (user % 31 == 0, F.concat(F.lit("svc-"), user_text, F.lit("-bot"))),
            ((user % 13 == 0) & (F.col("event_id") % 2 == 0),
             F.concat(F.lit("user-"), user_text, F.lit("-renamed"))),
            otherwise=F.concat(F.lit("user-"), user_text),
        ).cast("string").alias("actor_login"),
        "repo_id",
        _case(
            (repo.isNull(), F.concat(F.lit("ghost/repo-"), user_text)),
            (repo == 3, "github/repo-3"),
            (repo == 5, "org-5/.github"),
            ((repo == 7) & (user % 2 == 0), "dev-7/repo-7-old"),
            otherwise=F.concat(
                F.coalesce(org_text, F.concat(F.lit("dev-"), repo_text)), F.lit("/repo-"), repo_text,
                F.when((repo >= 50) & (k == 49), "-old").otherwise(""),
            ),
        ).alias("repo_name"),
        "org_id",
        F.when(~((cents == 5) & (k == 3)), org_text).alias("org_login"),
        "created_at",
        hour_key("ts").alias("source_file"),
        F.to_date("created_at").alias("event_date"),
    ).select(*EVENTS.names)


_stored: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def event_table(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The bound events as the models read them, partitioned by date and sorted by type:
    the table's path and the table.

    Written and listed once per session. The binding is deep and would otherwise be
    evaluated anew, and pushed into every filter, by each query.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = Scratch(spark).path("bound")
        arranged(bound_events(spark, sf_dir)).write.partitionBy("event_date").parquet(path)
        _stored[key] = path, spark.read.schema(EVENTS).parquet(path).select(*EVENTS.names)
    return _stored[key]


def bound_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    text_array = "array<string>"
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        (key + F.floor(key / 6)).alias("repo_id"),
        _case(
            (key % 6 == 3, F.lit("An AI Agent toolkit")), (key % 7 == 0, F.lit(None)),
            otherwise=F.col("p_name"),
        ).alias("description"),
        _case((key % 3 == 0, F.lit("Python")), (key % 3 == 1, F.lit("Rust")), otherwise=F.lit(None))
        .alias("language"),
        _case(
            (key % 5 == 0, F.array(F.lit("llm"), F.lit("rag"))),
            (key % 5 == 1, F.lit(None).cast(text_array)),
            (key % 5 == 2, F.array(F.lit("database"), F.lit("storage"))),
            (key % 5 == 3, F.array().cast(text_array)),
            otherwise=F.array(F.lit("cli")),
        ).alias("topics"),
        F.when(key % 4 != 0, "MIT").alias("license"),
        F.floor("p_retailprice").cast("bigint").alias("stargazers_count"),
        F.col("p_size").cast("bigint").alias("forks_count"),
        F.when(key % 2 == 0, "Organization").otherwise("User").alias("owner_type"),
        (key % 9 == 0).alias("is_fork"),
        (_time("2023-01-01 00:00:00") + F.make_dt_interval(key.cast("int"))).alias("created_at"),
        (AS_OF.time_ago() - F.make_dt_interval(F.col("p_size"))).alias("fetched_at"),
    ).select(*METADATA.names)


def bound_ledger(events: DataFrame) -> DataFrame:
    """A ledger of the hours present, quiet ones (under ten events) marked as failed."""
    rows = F.col("row_count")
    return events.groupBy(F.col("source_file").alias("hour_key")).agg(
        F.count("*").alias("row_count")
    ).select(
        "hour_key", "row_count", AS_OF.time_ago().alias("loaded_at"),
        F.when(rows >= 10, "loaded").otherwise("failed").alias("status"),
    )


def landed_records(events: DataFrame) -> DataFrame:
    """Events in the shape of landed JSON objects, with the hour file they belong to."""
    party = {
        "actor": F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")),
        "repo": F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")),
        "org": F.when(
            F.col("org_id").isNotNull(),
            F.struct(F.col("org_id").alias("id"), F.col("org_login").alias("login")),
        ),
    }
    time = F.concat(F.translate(F.col("created_at").cast("string"), " ", "T"), F.lit("Z"))
    return events.select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"),
        *[column.alias(name) for name, column in party.items()],
        time.alias("created_at"), F.col("source_file").alias("hour_key"),
    )
