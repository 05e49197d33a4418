"""Landed hour files: one JSON event per line, gzip, named by their hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.functions.events import utc_wall_clock
from forgepulse.schema import LANDED

# Fixed value: an hour key `yyyy-MM-dd-H` in a file name, or in a folder name
# such as `hour_key=2024-01-01-5`.
HOUR_IN_PATH = r".*[/=](\d{4}-\d{2}-\d{2}-\d{1,2})[./].*"
HOUR_IN_NAME = r"(?:^|=)(\d{4}-\d{2}-\d{2}-\d{1,2})(?:\.|$)"


def landed_events(records: DataFrame) -> DataFrame:
    """Landed records as flat events, with the raw text of unusable ones.

    `created` is the event time as a zoned timestamp, for watermarks; `file` names a landed
    file by its hour and its own name.
    """
    parsed = records.withColumn("created", F.col("created_at").try_cast("timestamp"))
    fields = F.struct(*[name for name in LANDED.names if name != "_corrupt_record"])
    event_id = F.col("id").try_cast("bigint")
    usable = F.col("_corrupt_record").isNull() & event_id.isNotNull() & F.col("created").isNotNull()
    created_at = utc_wall_clock(F.col("created"))
    hour = F.regexp_extract("_metadata.file_path", HOUR_IN_PATH, 1)
    return parsed.select(
        event_id.alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("org.id").alias("org_id"),
        F.col("org.login").alias("org_login"),
        created_at.alias("created_at"),
        hour.alias("source_file"),
        F.to_date(created_at).alias("event_date"),
        "created",
        F.concat(hour, F.lit("/"), "_metadata.file_name").alias("file"),
        F.when(~usable, F.coalesce("_corrupt_record", F.to_json(fields))).alias("unusable"),
    )


def read_landed(spark, paths: list[str]) -> DataFrame:
    """All given files in one read, so that files, not hours, set the parallelism."""
    return landed_events(spark.read.schema(LANDED).json(paths))


def stream_landed(spark, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of landed files as a stream, of `max_files` in a batch at most."""
    reader = spark.readStream.schema(LANDED).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return landed_events(reader.json(path))


def rejected(events: DataFrame) -> DataFrame:
    """The unusable records with their hour and file."""
    return events.where(F.col("unusable").isNotNull()).select(
        F.col("unusable").alias("record"), F.col("source_file").alias("hour_key"), "file"
    )
