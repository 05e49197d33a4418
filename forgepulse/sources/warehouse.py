"""The stored tables: events, files, quarantine, metadata and model results under one root.

Rows lie in segments, folders that are written once and never changed. A version names the
segments that count, so whatever a load, a rebuild or a compaction has written is published
by one commit, and a reader pinned to a version sees one state of all tables.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from copy import deepcopy
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgepulse.schema import EVENTS, FILES, LEDGER, METADATA, QUARANTINE, REJECTED
from forgepulse.sources.landing import HOUR_IN_NAME, HOUR_IN_PATH
from forgepulse.sources.storage import child_names, drop_folder, list_by_few_tasks, modified
from forgepulse.sources.versions import Conflict, Version, Versions

EVENT_SEGMENTS, FILE_SEGMENTS, REJECTED_SEGMENTS = "raw/events", "raw/files", "raw/quarantine"
METADATA_BASE, METADATA_DELTAS = "raw/metadata", "raw/metadata_deltas"
# Event dates by the number of the version that last added rows to them.
LAST_LOADED = "last_loaded"
SEGMENT = "segment"
# Buckets the metadata are stored by: an upsert is merged into those it has rows for.
BUCKETS = 64


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, version: Version | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.versions = Versions(spark, self.path("versions"))
        self._version = version
        list_by_few_tasks(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def version(self) -> Version:
        return self._version or self.versions.current()

    def pinned(self) -> Warehouse:
        """The warehouse as it is now, whatever is published later."""
        return Warehouse(self.spark, self.root, self.version())

    def publish(self, change: Callable[[dict, Version], None]) -> Version:
        """Commits what `change` does to a copy of the current content."""
        def changed(now: Version) -> dict:
            content = deepcopy(now.content)
            change(content, now)
            return content

        return self.versions.commit(changed)

    # Segments

    def segment_path(self, table: str, segment: str) -> str:
        return self.path(f"{table}/{SEGMENT}={segment}")

    def write_segment(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Writes rows nobody reads until a commit names their segment."""
        segment = uuid.uuid4().hex
        df.write.partitionBy(*partition_by).parquet(self.segment_path(table, segment))
        return segment

    def drop_segment(self, table: str, segment: str) -> None:
        drop_folder(self.spark, self.segment_path(table, segment))

    def partitions_of(self, table: str, segment: str) -> list[str]:
        """The values of the column a segment is partitioned by."""
        names = child_names(self.spark, self.segment_path(table, segment))
        return sorted(name.split("=", 1)[1] for name in names if "=" in name)

    def read_segments(
        self, table: str, schema: T.StructType, segments: Iterable[str] | dict[str, Sequence[str]],
        partition_by: str | None = None,
    ) -> DataFrame:
        """The rows of whole segments, or of some partitions of each."""
        if partition_by:
            paths = [
                f"{self.segment_path(table, segment)}/{partition_by}={value}"
                for segment, values in segments.items() for value in values
            ]
        else:
            paths = [self.segment_path(table, segment) for segment in segments]
        if not paths:
            # Without a row from Python, whose workers it would start on every executor.
            nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
            return self.spark.range(1).select(*nothing).where(F.lit(False))
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        return reader.parquet(*paths).select(*schema.names)

    # Events and the files they come from

    def events(self) -> DataFrame:
        """All published events, partitioned by `event_date`."""
        return self.events_of(self.version())

    def events_of(self, version: Version, dates: Iterable[date] | None = None) -> DataFrame:
        """The events of a version, or those of some dates of it."""
        only = None if dates is None else {day.isoformat() for day in dates}
        segments = {
            segment: [day for day in entry["dates"] if only is None or day in only]
            for segment, entry in version.get(EVENT_SEGMENTS).items()
        }
        return self.read_segments(EVENT_SEGMENTS, EVENTS, segments, "event_date")

    def files(self) -> DataFrame:
        """The newest entry of every file loaded."""
        rest = [name for name in FILES.names if name not in ("file", "batch")]
        return (
            self.read_segments(FILE_SEGMENTS, FILES, self.version().get(FILE_SEGMENTS))
            .groupBy("file").agg(F.max(F.struct("batch", *rest)).alias("entry"))
            .select("file", "entry.*").select(*FILES.names)
        )

    def ledger(self) -> DataFrame:
        """An entry for every hour with a loaded file; `loaded` once all files that had landed
        are, `partial` before."""
        return self.files().groupBy("hour_key").agg(
            F.sum("row_count").alias("row_count"), F.max("loaded_at").alias("loaded_at"),
            F.when(F.count("*") >= F.max("hour_files"), "loaded").otherwise("partial").alias("status"),
        ).select(*LEDGER.names)

    def quarantine(self) -> DataFrame:
        """The unusable records of every file's newest load."""
        rejected = self.read_segments(REJECTED_SEGMENTS, REJECTED, self.version().get(REJECTED_SEGMENTS))
        return rejected.join(self.files().select("file", "batch"), ["file", "batch"], "left_semi").select(
            *QUARANTINE.names
        )

    def append_events(self, events: DataFrame) -> None:
        """Publishes events as they are, without looking for stored ones."""
        segment = self.write_events(events)
        dates = self.partitions_of(EVENT_SEGMENTS, segment)
        self.publish(lambda content, now: add_events(content, now, segment, dates))

    def write_events(self, events: DataFrame) -> str:
        return self.write_segment(EVENT_SEGMENTS, arranged(events), ["event_date"])

    def touched(self) -> dict[str, list[date]]:
        """The segments the daily tables have not taken in yet, and the dates of each."""
        return {
            segment: [date.fromisoformat(day) for day in entry["pending"]]
            for segment, entry in self.version().get(EVENT_SEGMENTS).items() if entry["pending"]
        }

    # Metadata

    def metadata(self) -> DataFrame:
        """One record per repository: the merged buckets and what was fetched since."""
        from forgepulse.operators.enrichment import metadata_upsert

        version = self.version()
        base = self.metadata_base(version)
        deltas = version.get(METADATA_DELTAS)
        if not deltas:
            return base
        return metadata_upsert(base, self.read_segments(METADATA_DELTAS, METADATA, deltas))

    def metadata_base(self, version: Version, buckets: Iterable[str] | None = None) -> DataFrame:
        only = None if buckets is None else set(buckets)
        segments: dict[str, list[str]] = {}
        for bucket, segment in version.get(METADATA_BASE).items():
            if only is None or bucket in only:
                segments.setdefault(segment, []).append(bucket)
        stored = T.StructType([*METADATA.fields, T.StructField("bucket", T.IntegerType())])
        return self.read_segments(METADATA_BASE, stored, segments, "bucket").select(*METADATA.names)

    # Models

    def read(self, name: str) -> DataFrame:
        entry = self.version().get(name)
        if not entry:
            raise KeyError(f"{name} was never built")
        return self.read_entry(name, entry)

    def read_entry(self, name: str, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        return self.read_segments(name, schema, entry["segments"], entry["partition_by"])

    # Upkeep

    def vacuum(self, keep: int = 10, older_than: float = 24 * 3600) -> list[str]:
        """Deletes versions beyond the newest `keep`, and segments that none of these names
        and that were last written `older_than` seconds ago; a load that runs longer than
        that would lose its rows before it publishes them. Returns the segments' paths."""
        used = {
            (table, segment) for version in self.versions.forget(keep)
            for table, entries in version.content.items() for segment in _segments_of(table, entries)
        }
        gone = []
        for table in self._tables():
            for name in child_names(self.spark, self.path(table)):
                segment = name.removeprefix(f"{SEGMENT}=")
                path = self.segment_path(table, segment)
                if segment == name or (table, segment) in used:
                    continue
                if time.time() - modified(self.spark, path) >= older_than:
                    drop_folder(self.spark, path)
                    gone.append(path)
        return gone

    def _tables(self) -> list[str]:
        return [
            f"{layer}/{name}" for layer in ("raw", "intermediate", "marts")
            for name in child_names(self.spark, self.path(layer))
        ]


def _segments_of(table: str, entries: dict) -> Iterable[str]:
    if table == METADATA_BASE:
        return entries.values()
    if table == LAST_LOADED:
        return ()
    return entries.get("segments", entries)


def arranged(events: DataFrame) -> DataFrame:
    """Events as they are written, by date.

    Rebalancing by date keeps a small hour in one file and lets adaptive execution
    split a large date over many tasks. Sorting by type gives each file's row groups
    narrow type ranges, which filters on the type can skip by.
    """
    return (
        events.select(*EVENTS.names)
        .hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_type", "repo_id")
    )


def add_events(content: dict, now: Version, segment: str, dates: Sequence[str]) -> None:
    """Names a segment of new rows of these dates, which the daily tables are to take in."""
    if dates:
        content.setdefault(EVENT_SEGMENTS, {})[segment] = {"dates": list(dates), "pending": list(dates)}
        content.setdefault(LAST_LOADED, {}).update(dict.fromkeys(dates, now.number + 1))


def check_not_loaded_since(base: Version, now: Version, dates: Sequence[str]) -> None:
    """Fails if another load published rows of these dates after `base`."""
    taken = [day for day in dates if now.get(LAST_LOADED).get(day, 0) > base.number]
    if taken:
        raise Conflict(f"events of {taken[0]} were published meanwhile")


def landed_hours(spark: SparkSession, folder: str) -> dict[str, str]:
    """The landed hour keys of a folder and their paths."""
    found = {}
    for name in child_names(spark, folder):
        match = re.search(HOUR_IN_NAME, name)
        if match:
            found[match.group(1)] = f"{folder.rstrip('/')}/{name}"
    return found


def landed_paths(spark: SparkSession, *paths: str) -> list[str]:
    """All files below these paths, listed by Spark's tasks where there are many; contents
    are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return sorted(row.path for row in listed.select("path").collect())


def landed_files(spark: SparkSession, paths: dict[str, str]) -> list[tuple[str, str]]:
    """(file, hour key) of the landed files at these hours' paths."""
    found = []
    for path in landed_paths(spark, *paths.values()) if paths else []:
        hour = re.search(HOUR_IN_PATH, path).group(1)
        found.append((f"{hour}/{path.rsplit('/', 1)[1]}", hour))
    return found


def hour_frame(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(key,) for key in keys], "hour_key string").select(
        F.col("hour_key")
    )
