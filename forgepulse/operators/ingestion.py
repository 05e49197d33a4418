"""Loading landed hours into the event table, so that repeating a load changes nothing.

A load is written, audited and published: its rows and its files' entries lie in segments
that no reader sees until one commit names them all.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgepulse.clock import AsOf
from forgepulse.functions.events import EPOCH, hour_key
from forgepulse.operators.quality import REQUIRED
from forgepulse.schema import EVENTS, FILES, REJECTED
from forgepulse.sources.landing import read_landed, rejected
from forgepulse.sources.storage import Scratch
from forgepulse.sources.versions import Conflict, Version
from forgepulse.sources.warehouse import (
    EVENT_SEGMENTS, FILE_SEGMENTS, REJECTED_SEGMENTS, Warehouse, add_events, check_not_loaded_since,
    landed_files, landed_hours,
)

# Times a load is worked out anew because others published rows of its dates first.
ATTEMPTS = 20


def backfill_hours(spark: SparkSession, first: date | str, last: date | str) -> DataFrame:
    """The hour keys of all days from `first` to `last`, both included."""
    days = spark.range(1).select(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"))
    return hours_between(days, F.col("first"), F.col("last"))


def hours_between(days: DataFrame, first: Column, last: Column) -> DataFrame:
    start = first.cast("timestamp_ntz")
    end = last.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(23))
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    return (
        days.where(first <= last)
        # The optimizer may evaluate the sequence of an empty range before dropping it.
        .select(F.explode(F.sequence(start, F.greatest(start, end), hour)).alias("hour"))
        .select(hour_key("hour").alias("hour_key"))
    )


def pending_hours(hours: DataFrame, ledger: DataFrame) -> DataFrame:
    """The hours the ledger does not record as loaded."""
    return hours.join(ledger.where(F.col("status") == "loaded"), "hour_key", "left_anti")


def _hour_number(key: Column) -> Column:
    """Hours since 1970 of a key `yyyy-MM-dd-H`."""
    day = F.date_diff(F.substring(key, 1, 10).cast("date"), F.lit("1970-01-01").cast("date"))
    return day * 24 + F.substring_index(key, "-", -1).cast("int")


def _hour_of(number: Column) -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), number.cast("int"))


def loaded_intervals(ledger: DataFrame) -> DataFrame:
    """The loaded hours as intervals (first, last), hours since 1970: an island for each run.

    The hours of a day are islands within a window of their own; only those, a row for each
    day and gap, pass through the window over all days.
    """
    number = F.col("number")
    hours = ledger.where(F.col("status") == "loaded").select(_hour_number(F.col("hour_key")).alias("number"))
    day = F.floor(number / 24)
    in_day = Window.partitionBy("day").orderBy("number")
    islands = (
        hours.where(number.isNotNull()).distinct().withColumn("day", day)
        .withColumn("island", number - F.row_number().over(in_day))
        .groupBy("day", "island").agg(F.min("number").alias("first"), F.max("number").alias("last"))
    )
    over_days = Window.orderBy("first")
    begins = F.coalesce(F.col("first") != F.lag("last").over(over_days) + 1, F.lit(True))
    return (
        islands.withColumn("begins", begins)
        .withColumn("run", F.count_if("begins").over(over_days.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select("first", "last")
    )


def pending_intervals(days: DataFrame, first: Column, last: Column, loaded: DataFrame) -> DataFrame:
    """The hours of all days from `first` to `last` outside the loaded intervals, as intervals
    (first_hour, last_hour, hours). No row is made for an hour; the window passes a row for
    each interval. `days` has one row."""
    start, end = (F.date_diff(day, F.lit("1970-01-01").cast("date")) * 24 for day in (first, last))
    wanted = days.where(first <= last).select(start.alias("from"), (end + 23).alias("to"))
    # An hour before and one after hold the first and the last gap, and carry the bounds.
    hours = [F.col("from") - 1, F.col("to") + 1]
    bounds = [wanted.select(at.alias("first"), at.alias("last"), "from", "to") for at in hours]
    unbounded = [F.lit(None).cast("int").alias(name) for name in ("from", "to")]
    in_order, anywhere = Window.orderBy("first", "last"), Window.partitionBy()
    gaps = loaded.select("first", "last", *unbounded).unionByName(bounds[0]).unionByName(bounds[1]).select(
        (F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) + 1).alias("gap"),
        (F.lead("first").over(in_order) - 1).alias("until"),
        F.max("from").over(anywhere).alias("from"), F.max("to").over(anywhere).alias("to"),
    )
    clipped = gaps.select(F.greatest("gap", "from").alias("gap"), F.least("until", "to").alias("until"))
    return clipped.where(F.col("gap") <= F.col("until")).select(
        _hour_of(F.col("gap")).alias("first_hour"), _hour_of(F.col("until")).alias("last_hour"),
        (F.col("until") - F.col("gap") + 1).cast("bigint").alias("hours"),
    )


def marked_ids(repeated: DataFrame, known: DataFrame) -> DataFrame:
    """The ids that repeat or are known, and whether they are known."""
    return known.select("event_id", F.lit(True).alias("known")).unionByName(
        repeated.join(known, "event_id", "left_anti").select("event_id", F.lit(False).alias("known"))
    )


def one_per_event(events: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per event id that is not known, the one from the earliest-named file.

    `marks` are the `marked_ids`, a narrow list, joined once to the whole rows; it is to be
    stored, so that its size is known and whole rows are shuffled by id only where it is
    large. Only the rows of repeated ids are grouped, and all others pass as they are. An
    aggregate rather than a window: copies are combined before the shuffle, so an event
    repeated any number of times is no large group.
    """
    rest = [name for name in EVENTS.names if name not in ("event_id", "source_file")]
    new = events.select(*EVENTS.names).join(marks, "event_id", "left").where("known is null or not known")
    copies = (
        new.where("known is not null").groupBy("event_id")
        .agg(F.min(F.struct("source_file", *rest)).alias("row"))
        .select("event_id", "row.*")
        .select(*EVENTS.names)
    )
    return new.where("known is null").select(*EVENTS.names).unionByName(copies)


@dataclass(frozen=True)
class Load:
    """What a load covered: the event dates it added rows to, and the nulls among its usable
    records in each column that must not have any."""

    dates: list[date]
    null_failures: dict[str, int] = field(default_factory=dict)


class NullsFound(ValueError):
    """Records without a value in columns that must have one."""


def load_files(
    warehouse: Warehouse, landed: DataFrame, files: list[tuple[str, str]], hour_files: dict[str, int],
    as_of: AsOf, scratch: Scratch, only_report_nulls: bool = False,
) -> Load:
    """Loads the landed records of some files (file, hour), which are read several times.

    `hour_files` has the number of files landed for each hour. The files' entries (usable
    events of each, whatever other files hold), their unusable records and the rows not
    stored yet are written, and published together. With nulls in required columns of the
    landed records nothing is: the load fails, and fails again until the file is repaired,
    unless `only_report_nulls` leaves it to the reader of `Load.null_failures`.

    Safe to repeat, and beside other loads: rows already stored are recognised by their id,
    and a load that others were first with on one of its dates compares its ids anew. An
    event keeps its creation time in every file, so only the stored dates that occur in the
    batch are compared. The collected lists hold days and files, not rows.
    """
    spark, batch_id = warehouse.spark, time.time_ns() // 1000
    batch = landed.where(F.col("unusable").isNull())
    # The audit adds up before its shuffle; ids with their files are a narrow list.
    days = batch.groupBy("event_date").agg(
        *[F.count_if(F.col(name).isNull()).alias(name) for name in REQUIRED]
    ).collect()
    nulls = {name: sum(day[name] for day in days) for name in REQUIRED}
    if any(nulls.values()) and not only_report_nulls:
        raise NullsFound(f"nulls in required columns: {({k: v for k, v in nulls.items() if v})}")
    dates = sorted(day.event_date for day in days)
    seen = scratch.keep(batch.groupBy("event_id", "file").agg(F.count("*").alias("n")))
    repeated = scratch.keep(seen.groupBy("event_id").agg(F.sum("n").alias("n")).where("n > 1").select("event_id"))

    named = spark.createDataFrame(
        [(file, hour, hour_files[hour]) for file, hour in files],
        "file string, hour_key string, hour_files bigint",
    )
    counts = seen.groupBy("file").agg(F.count("*").alias("row_count"))
    entries = named.join(counts, "file", "left").fillna(0, subset=["row_count"]).withColumns({
        "batch": F.lit(batch_id), "loaded_at": as_of.time_ago(),
    })
    written = {
        FILE_SEGMENTS: warehouse.write_segment(FILE_SEGMENTS, entries.select(*FILES.names).coalesce(1)),
        REJECTED_SEGMENTS: warehouse.write_segment(
            REJECTED_SEGMENTS, rejected(landed).withColumn("batch", F.lit(batch_id)).select(*REJECTED.names)
        ),
    }
    for _ in range(ATTEMPTS):
        base = warehouse.version()
        stored = warehouse.events_of(base, dates).select("event_id")
        known = scratch.keep(stored.join(seen, "event_id", "left_semi"))
        marks = scratch.keep(marked_ids(repeated, known))
        segment = warehouse.write_events(one_per_event(batch, marks))
        added = warehouse.partitions_of(EVENT_SEGMENTS, segment)

        def change(content: dict, now: Version) -> None:
            check_not_loaded_since(base, now, [day.isoformat() for day in dates])
            add_events(content, now, segment, added)
            for table, name in written.items():
                content.setdefault(table, {})[name] = {"batch": batch_id}

        try:
            warehouse.publish(change)
            return Load([date.fromisoformat(day) for day in added], nulls)
        except Conflict:
            warehouse.drop_segment(EVENT_SEGMENTS, segment)
    raise Conflict(f"other loads were first {ATTEMPTS} times")


def ingest_hours(
    warehouse: Warehouse, folder: str, keys: list[str], as_of: AsOf, only_report_nulls: bool = False
) -> Load:
    """Loads landed hours, all their files, in one pass; an hour without a file stays pending."""
    paths = landed_hours(warehouse.spark, folder)
    present = {key: paths[key] for key in dict.fromkeys(keys) if key in paths}
    files = landed_files(warehouse.spark, present)
    if not files:
        return Load([], dict.fromkeys(REQUIRED, 0))
    with Scratch(warehouse.spark, warehouse.path("_scratch")) as scratch:
        # Compressed JSON cannot be split or pruned; it is read once.
        landed = scratch.keep(read_landed(warehouse.spark, list(present.values())).drop("created"))
        return load_files(
            warehouse, landed, files, files_of_hours(files), as_of, scratch, only_report_nulls
        )


def files_of_hours(files: list[tuple[str, str]]) -> dict[str, int]:
    counts: dict[str, int] = {}
    for _, hour in files:
        counts[hour] = counts.get(hour, 0) + 1
    return counts


def ingest_hour(
    warehouse: Warehouse, folder: str, key: str, as_of: AsOf, only_report_nulls: bool = False
) -> Load:
    return ingest_hours(warehouse, folder, [key], as_of, only_report_nulls)
