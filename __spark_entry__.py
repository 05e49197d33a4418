
from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse import binding
from forgepulse.binding import AS_OF
from forgepulse.functions.events import hour_key
from forgepulse.operators import community, enrichment, ingestion, profiles, quality, staging, trending
from forgepulse.operators.activity import (
    activity_of_events, daily_pairs, daily_signals, int_repo_daily_activity,
)
from forgepulse.plans import layers, pipeline, upkeep
from forgepulse.schema import EVENT_COLUMNS, EVENTS
from forgepulse.sources.storage import Scratch
from forgepulse.sources.warehouse import Warehouse, landed_files, landed_hours, landed_paths
from forgepulse.streaming import hourly, ingest

Query = Callable[[SparkSession, str], DataFrame]

ORACLE = Path(__file__).parent / "oracle"


def _as_text(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as comma-joined text, which both engines compare alike."""
    return df.withColumns({name: F.array_join(name, ",") for name in arrays})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.event_table(spark, sf_dir)[1]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(*EVENT_COLUMNS)


def repo_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(binding.bound_metadata(spark, sf_dir), "topics")


_landings: dict[tuple[str, str], str] = {}


def _land(spark: SparkSession, sf_dir: str) -> str:
    """The events as gzip JSON in a folder per hour, two files each (even and odd ids), an
    unusable record in every file; written once per session, in one pass over the input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        folder = Scratch(spark).path("landing")
        # Bound as they are read: storing the event table first would cost a shuffle of its own.
        records = binding.landed_records(binding.bound_events(spark, sf_dir))
        fields = [name for name in records.columns if name != "hour_key"]
        lines = records.select(
            "hour_key", F.pmod(F.col("id").cast("bigint"), F.lit(2)).alias("slot"),
            F.to_json(F.struct(*fields)).alias("value"),
        )
        broken = lines.select("hour_key", "slot").distinct().withColumn(
            "value", F.concat(F.lit("{broken "), "hour_key", F.lit(" "), F.col("slot").cast("string"))
        )
        # A task writes a file for each of its hours, so no task has both slots; the even ids'
        # tasks come first, and so do their files in a stream.
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        task = F.col("slot").cast("int") * tasks + F.pmod(F.hash("hour_key"), F.lit(tasks))
        lines.unionByName(broken).where(F.col("slot").isin(0, 1)).repartitionById(2 * tasks, task).select(
            "hour_key", "value"
        ).write.partitionBy("hour_key").option("compression", "gzip").text(folder)
        _landings[key] = folder
    return _landings[key]


def ingest_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    folder = _land(spark, sf_dir)
    warehouse = Warehouse(spark, scratch.path("warehouse"))
    ingestion.ingest_hours(warehouse, folder, list(landed_hours(spark, folder)), AS_OF)
    return warehouse.events().select(*EVENT_COLUMNS)


def _in_two_loads(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, str]:
    """A warehouse whose earlier half of the hours is loaded."""
    folder = _land(spark, sf_dir)
    warehouse = Warehouse(spark, Scratch(spark).path("warehouse"))
    hours = sorted(landed_hours(spark, folder))
    ingestion.ingest_hours(warehouse, folder, hours[: len(hours) // 2], AS_OF)
    return warehouse, folder


def concurrent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads side by side of overlapping hours, in which events of the same dates occur."""
    folder = _land(spark, sf_dir)
    warehouse = Warehouse(spark, Scratch(spark).path("warehouse"))
    hours = sorted(landed_hours(spark, folder))
    part = -(-len(hours) // 4)
    loads = [hours[max(0, at - part // 2):at + part] for at in range(0, len(hours), part)]
    with ThreadPool(len(loads)) as pool:
        pool.map(lambda keys: ingestion.ingest_hours(warehouse, folder, keys, AS_OF), loads, chunksize=1)
    return warehouse.events().select(*EVENT_COLUMNS)


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by date after two loads and a compaction: the rows, a sum of the ids, and the
    segments they lie in."""
    warehouse, folder = _in_two_loads(spark, sf_dir)
    ingestion.ingest_hours(warehouse, folder, sorted(landed_hours(spark, folder)), AS_OF)
    upkeep.compact_events(warehouse, segments=1)
    segment = F.regexp_extract(F.input_file_name(), "segment=([0-9a-f]+)", 1)
    return warehouse.events().withColumn("segment", segment).groupBy("event_date").agg(
        F.count("*").alias("row_count"), F.sum("event_id").alias("id_sum"),
        F.count_distinct("segment").alias("segments"),
    )


def hour_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return events.select("event_id", hour_key("created_at").alias("hour_key"))


def backfill_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours of the days between the first and the last event."""
    days = _events(spark, sf_dir).agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last")
    )
    return ingestion.hours_between(days, F.col("first"), F.col("last"))


def pending_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = binding.bound_ledger(_events(spark, sf_dir))
    return ingestion.pending_hours(backfill_hours(spark, sf_dir), ledger)


def pending_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hours as intervals, from the ledger's intervals."""
    events = _events(spark, sf_dir)
    days = events.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last"))
    loaded = ingestion.loaded_intervals(binding.bound_ledger(events))
    return ingestion.pending_intervals(days, F.col("first"), F.col("last"), loaded)


def enrichment_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.enrichment_candidates(
        _events(spark, sf_dir), binding.bound_metadata(spark, sf_dir), AS_OF
    )


def metadata_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merges records with stars added up, fetched at each repository's last event."""
    current = binding.bound_metadata(spark, sf_dir)
    seen = _events(spark, sf_dir).groupBy("repo_id").agg(
        F.count_if(F.col("event_type") == "WatchEvent").alias("stars"),
        F.max("created_at").alias("last_at"),
    )
    records = current.join(seen, "repo_id").withColumns({
        "stargazers_count": F.col("stargazers_count") + F.col("stars"),
        "fetched_at": F.col("last_at"),
    })
    merged = enrichment.metadata_upsert(current, records.select(*current.columns))
    return _as_text(merged, "topics")


def write_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    warehouse = Warehouse(spark, scratch.path("warehouse"))
    activity = activity_of_events(_events(spark, sf_dir), scratch)
    return layers.write_model(warehouse, layers.ACTIVITY, activity)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*quality.REQUIRED, "repo_id", "actor_login", "org_login"]
    return quality.dq_not_null(_events(spark, sf_dir), "events", columns)


def run_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from landed files, the earlier hours of which are loaded already; of every
    model as stored its rows, and of each column the nulls and, of numbers, the sum."""
    warehouse, folder = _in_two_loads(spark, sf_dir)
    records = binding.bound_metadata(spark, sf_dir)
    models = pipeline.run_pipeline(warehouse, AS_OF, folder, records)
    views = staging.staging_views(warehouse.events())
    return reduce(DataFrame.unionByName, [
        _profile(views[model] if model in views else layers.read_model(warehouse, model), model)
        for model in models
    ])


# Sums of doubles depend on their order, so numbers are summed as millionths.
_NUMBERS = {"bigint", "int", "double"}


def _profile(df: DataFrame, model: str) -> DataFrame:
    """A row for each column: the rows of its model, its nulls and, of numbers, their sum."""
    kinds = dict(df.dtypes)
    values = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(F.col(name).isNull()).alias("nulls"),
            (
                F.sum(F.round(F.col(name).cast("double") * 1_000_000).cast("decimal(38,0)"))
                .cast("string") if kinds[name] in _NUMBERS else F.lit(None).cast("string")
            ).alias("millionths"),
        )
        for name in sorted(df.columns)
    ]
    return (
        df.agg(F.count("*").alias("row_count"), F.array(*values).alias("columns"))
        .select(F.lit(model).alias("model"), "row_count", F.explode("columns").alias("own"))
        .select("model", "row_count", "own.*")
    )


def _streamed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Loaded in at least three micro-batches that part the files of hours, then once more
    from the same checkpoint."""
    scratch = Scratch(spark)
    folder = _land(spark, sf_dir)
    warehouse = Warehouse(spark, scratch.path("warehouse"))
    files = -(-len(landed_files(spark, landed_hours(spark, folder))) // 3) | 1
    for _ in range(2):
        ingest.load_available(
            warehouse, folder, AS_OF, scratch.path("state"), files
        ).awaitTermination()
    return warehouse


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).events().select(*EVENT_COLUMNS)


def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a streamed load, with the quarantined records of each hour."""
    warehouse = _streamed(spark, sf_dir)
    rejected = warehouse.quarantine().groupBy("hour_key").agg(F.count("*").alias("rejected"))
    return warehouse.ledger().join(rejected, "hour_key").select(
        "hour_key", "row_count", "status", "rejected"
    )


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    source, _ = binding.event_table(spark, sf_dir)
    hours = hourly.stream_hourly(spark.readStream.schema(EVENTS).parquet(source), "1 hour")
    path = scratch.path("hours")
    ingest.write_available(hours, path, scratch.path("state")).awaitTermination()
    return spark.read.schema(hours.schema).parquet(path)


def stream_hourly_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours, kept by a stream over the event table's files in several batches."""
    scratch = Scratch(spark)
    source, _ = binding.event_table(spark, sf_dir)
    warehouse = Warehouse(spark, scratch.path("warehouse"))
    files = -(-len(landed_paths(spark, source)) // 3)
    hourly.keep_hours(warehouse, source, scratch.path("state"), files).awaitTermination()
    return layers.read_model(warehouse, layers.HOURS).drop("activity_date")


def _staging_view(event_type: str) -> Query:
    return lambda spark, sf_dir: staging.events_of_type(
        _events(spark, sf_dir), event_type
    )


def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_of_events(_events(spark, sf_dir))


def contributor_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.int_contributor_profiles(_events(spark, sf_dir), AS_OF)


def org_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.int_org_activity(_events(spark, sf_dir), AS_OF)


def trending_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the report's days of daily activity are built; a day needs no other day."""
    events = _events(spark, sf_dir).where(F.col("event_date") >= AS_OF.date_ago(30))
    scratch = Scratch(spark)
    return trending.mart_trending_repos(scratch.keep(activity_of_events(events, scratch)), AS_OF)


def _topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trending.mart_trending_by_topic(
        trending_repos(spark, sf_dir), binding.bound_metadata(spark, sf_dir)
    )


def trending_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(_topic_rows(spark, sf_dir), "topic_tags")


def ai_ecosystem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(trending.mart_ai_ecosystem(_topic_rows(spark, sf_dir), AS_OF), "topic_tags")


def ecosystem_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.mart_ecosystem_hourly(_events(spark, sf_dir), AS_OF)


def org_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.mart_org_scoreboard(Scratch(spark).keep(org_activity(spark, sf_dir)))


def contributor_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    movers = community.mart_contributor_migration(
        _events(spark, sf_dir), contributor_profiles(spark, sf_dir), AS_OF
    )
    return _as_text(movers, "orgs")


def fork_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return community.mart_fork_conversion(events, daily_signals(events), AS_OF)


def release_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.mart_release_momentum(_events(spark, sf_dir), AS_OF)


def new_repo_breakout(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    signals = scratch.keep(daily_signals(_events(spark, sf_dir)))
    return trending.mart_new_repo_breakout(signals, int_repo_daily_activity(signals, scratch), AS_OF)


def viral_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the report's days of daily counts are built; a day needs no other day."""
    days = F.col("event_date").between(AS_OF.date_ago(8), AS_OF.date_ago(1))
    return community.mart_viral_velocity(daily_signals(_events(spark, sf_dir).where(days)), AS_OF)


def daily_pairs_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_pairs(_events(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """The flagship, through the deepest chain of models."""
    return ai_ecosystem(spark, "/root/testdata/sf0.001")


# The corpus operators are an optional subpackage: without it the other queries stay.
try:
    from forgepulse.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name != "forgepulse.llm":
        raise
    corpus = None


def queries() -> dict[str, Query]:
    return own_queries() | (corpus.QUERIES if corpus else {})


def own_queries() -> dict[str, Query]:
    return {
        "raw_events": raw_events,
        "repo_metadata": repo_metadata,
        "ingest_hour": ingest_hour,
        "hour_key": hour_keys,
        "backfill_hours": backfill_hours,
        "pending_hours": pending_hours,
        "enrichment_candidates": enrichment_candidates,
        "metadata_upsert": metadata_upsert,
        "write_layer": write_layer,
        "dq_not_null": dq_not_null,
        "run_pipeline": run_pipeline,
        **{name: _staging_view(event_type) for name, event_type in staging.VIEWS.items()},
        "int_repo_daily_activity": daily_activity,
        "int_daily_pairs": daily_pairs_of_events,
        "int_contributor_profiles": contributor_profiles,
        "int_org_activity": org_activity,
        "mart_trending_repos": trending_repos,
        "mart_trending_by_topic": trending_by_topic,
        "mart_ai_ecosystem": ai_ecosystem,
        "mart_ecosystem_hourly": ecosystem_hourly,
        "mart_org_scoreboard": org_scoreboard,
        "mart_contributor_migration": contributor_migration,
        "mart_fork_conversion": fork_conversion,
        "mart_release_momentum": release_momentum,
        "mart_new_repo_breakout": new_repo_breakout,
        "mart_viral_velocity": viral_velocity,
        "stream_ingest": stream_ingest,
        "stream_ledger": stream_ledger,
        "concurrent_loads": concurrent_loads,
        "compaction": compaction,
        "stream_hourly": stream_hourly,
        "stream_hourly_corrected": stream_hourly_corrected,
        "pending_intervals": pending_intervals,
    }


def _with_inputs(name: str, texts: dict[str, str], done: dict[str, str]) -> None:
    """Adds the texts `name` refers to, then its own, so that each follows its inputs."""
    if name in done:
        return
    for other in texts:
        if other != name and re.search(rf"\b(?:from|join)\s+{other}\b", texts[name]):
            _with_inputs(other, texts, done)
    done[name] = texts[name]


def oracle_sql() -> dict[str, str]:
    texts = {path.stem: path.read_text().strip() for path in sorted(ORACLE.glob("*.sql"))}
    result = {}
    for name in own_queries():
        chain: dict[str, str] = {}
        _with_inputs(name, texts, chain)
        body = chain.pop(name)
        inputs = ",\n".join(f"{other} as materialized (\n{text}\n)" for other, text in chain.items())
        result[name] = f"with {inputs}\nselect * from (\n{body}\n)"
    return result | (corpus.ORACLE if corpus else {})
