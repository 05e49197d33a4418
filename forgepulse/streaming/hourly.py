"""Hourly activity as a stream, with exact distinct counts: closed hours once behind a
watermark, or every hour at once, corrected whenever an event of it comes late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgepulse.functions.events import as_instant, utc_wall_clock
from forgepulse.operators.community import hourly_activity, hourly_ratios
from forgepulse.plans.layers import HOURS, Build
from forgepulse.schema import EVENTS
from forgepulse.sources.versions import Conflict
from forgepulse.sources.warehouse import Warehouse


def stream_hourly(events: DataFrame, delay: str) -> DataFrame:
    """Closed hours of an event stream, in the columns of the batch report.

    Streams reject distinct counts, so each event counts once under its actor and
    once under its repository, and the second aggregate counts those. Its first
    state is keyed by (hour, type, actor or repository), which spreads a hot type;
    hours leave the state when the watermark passes them.
    """
    hour = "1 hour"
    counted = (
        events.withColumn("at", as_instant(events, "created_at"))
        .withWatermark("at", delay)
        .select("at", "event_type", F.explode(F.create_map(
            F.lit("actor"), F.col("actor_id"), F.lit("repo"), F.col("repo_id"),
        )).alias("kind", "id"))
        .groupBy(F.window("at", hour).alias("hour"), "event_type", "kind", "id")
        .agg(F.count("*").alias("events"))
    )
    an_actor, a_repo = F.col("kind") == "actor", F.col("kind") == "repo"
    known = F.col("id").isNotNull()
    hours = (
        counted.groupBy(F.window(F.window_time("hour"), hour).alias("hour"), "event_type")
        .agg(
            F.sum(F.when(an_actor, F.col("events"))).alias("event_count"),
            F.count_if(an_actor & known).alias("unique_actors"),
            F.count_if(a_repo & known).alias("unique_repos"),
        )
        .select(
            utc_wall_clock(F.col("hour.start")).alias("activity_hour"), "event_type",
            "event_count", "unique_actors", "unique_repos",
        )
    )
    return hourly_ratios(hours)


def keep_hours(
    warehouse: Warehouse, source: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Takes new files of an event table into the stored hourly activity, then stops.

    The hours are stored by date. Each micro-batch says which dates it has events of; these
    are counted anew from the table, so distinct counts are exact, and replaced in one
    step. So an hour is right whenever its events come, in whatever order and batches, and
    a batch repeated after a failure changes nothing. Work grows with the dates touched, a
    late event costs one date. The collected list holds dates.
    """
    spark = warehouse.spark

    def correct(batch: DataFrame, _: int) -> None:
        dates = [row.event_date for row in batch.select("event_date").distinct().collect()]
        dates = sorted(day for day in dates if day is not None)
        if not dates:
            return
        while True:
            events = spark.read.schema(EVENTS).parquet(source).where(F.col("event_date").isin(dates))
            hours = hourly_activity(events).withColumn("activity_date", F.to_date("activity_hour"))
            build = Build(warehouse)
            build.write(HOURS, hours, dates)
            try:
                return build.publish()
            except Conflict:
                build.drop()

    reader = spark.readStream.schema(EVENTS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source).writeStream.foreachBatch(correct)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
