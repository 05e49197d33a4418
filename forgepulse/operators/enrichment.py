"""The data work on both sides of fetching repository metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse import rules
from forgepulse.clock import AsOf
from forgepulse.functions.events import since, with_event_date
from forgepulse.schema import METADATA
from forgepulse.sources.versions import Conflict, Version
from forgepulse.sources.warehouse import BUCKETS, METADATA_BASE, METADATA_DELTAS, Warehouse


def enrichment_candidates(
    events: DataFrame, metadata: DataFrame, as_of: AsOf, batch: int = rules.ENRICHMENT_BATCH
) -> DataFrame:
    """The most active repositories of the last days without a fresh record.

    The limit is the size of a run's request batch; each task keeps its best rows, so
    nothing is sorted as a whole.
    """
    recent = since(with_event_date(events), as_of, rules.ENRICHMENT_ACTIVE_DAYS)
    by_name = recent.where(F.col("repo_id").isNotNull()).groupBy("repo_id", "repo_name").agg(
        F.count("*").alias("n_events"), F.max("created_at").alias("last_at")
    )
    by_repo = by_name.groupBy("repo_id").agg(
        F.max_by("repo_name", F.struct("last_at", "repo_name")).alias("repo_name"),
        F.sum("n_events").alias("recent_events"),
    )
    fresh = metadata.where(F.col("fetched_at") >= as_of.time_ago(rules.ENRICHMENT_FRESH_DAYS))
    return (
        by_repo.join(fresh.select("repo_id"), "repo_id", "left_anti")
        .orderBy(F.desc("recent_events"), "repo_id")
        .limit(batch)
    )


def metadata_upsert(current: DataFrame, records: DataFrame) -> DataFrame:
    """The current table with fetched records merged in: the latest per repository.

    Of equally late versions the fetched one wins. An aggregate rather than a window,
    so many versions of one repository are combined before the shuffle.
    """
    versions = current.withColumn("fetched", F.lit(0)).unionByName(
        records.withColumn("fetched", F.lit(1))
    )
    rest = [name for name in METADATA.names if name not in ("repo_id", "fetched_at")]
    return (
        versions.where(F.col("repo_id").isNotNull())
        .groupBy("repo_id")
        .agg(F.max(F.struct("fetched_at", "fetched", *rest)).alias("row"))
        .select("repo_id", "row.*")
        .select(*METADATA.names)
    )


def upsert_metadata(warehouse: Warehouse, records: DataFrame) -> None:
    """Publishes fetched records as a delta, which reads merge into what is stored; the
    buckets are not touched."""
    segment = warehouse.write_segment(METADATA_DELTAS, records.select(*METADATA.names))

    def change(content: dict, now: Version) -> None:
        content.setdefault(METADATA_DELTAS, {})[segment] = {}

    warehouse.publish(change)


def merge_metadata(warehouse: Warehouse) -> list[str]:
    """Rewrites the buckets that deltas have rows for, publishes them without the deltas, and
    returns them. Deltas that come meanwhile stay."""
    base = warehouse.version()
    deltas = list(base.get(METADATA_DELTAS))
    if not deltas:
        return []
    bucket = F.pmod(F.xxhash64("repo_id"), F.lit(BUCKETS)).cast("int")
    known = F.col("repo_id").isNotNull()
    records = warehouse.read_segments(METADATA_DELTAS, METADATA, deltas).where(known)
    # A bucket's number each, not rows.
    touched = [str(row.bucket) for row in records.select(bucket.alias("bucket")).distinct().collect()]
    merged = metadata_upsert(warehouse.metadata_base(base, touched), records).withColumn("bucket", bucket)
    segment = warehouse.write_segment(METADATA_BASE, merged.hint("rebalance", "bucket"), ["bucket"])

    def change(content: dict, now: Version) -> None:
        if any(now.get(METADATA_BASE).get(name) != base.get(METADATA_BASE).get(name) for name in touched):
            raise Conflict("metadata were merged meanwhile")
        content.setdefault(METADATA_BASE, {}).update(dict.fromkeys(touched, segment))
        for delta in deltas:
            content[METADATA_DELTAS].pop(delta, None)

    warehouse.publish(change)
    return sorted(touched, key=int)
