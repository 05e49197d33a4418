"""Column helpers shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgepulse.clock import AsOf

EPOCH = "1970-01-01 00:00:00"


def with_event_date(events: DataFrame) -> DataFrame:
    """Adds the partition column to events that come without it."""
    if "event_date" in events.columns:
        return events
    return events.withColumn("event_date", F.to_date("created_at"))


def since(events: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Events created in the last `days` days, with no upper bound.

    The bound on `event_date` follows from the one on `created_at`; Spark does not
    derive it, and it is what prunes partitions.
    """
    return events.where(
        (F.col("event_date") >= as_of.date_ago(days)) & (F.col("created_at") >= as_of.time_ago(days))
    )


def counted(events: DataFrame) -> DataFrame:
    """Events as rows that each stand for `n` of them, from `first_at` to `last_at`."""
    if "n" in events.columns:
        return events
    return events.withColumns({
        "n": F.lit(1).cast("bigint"), "first_at": F.col("created_at"), "last_at": F.col("created_at"),
    })


def recent_counts(events: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """The events of the last `days` days, counted; counts given are those of the window."""
    if "n" in events.columns:
        return events
    return counted(since(with_event_date(events), as_of, days))


def count_of(*types: str) -> Column:
    """How many events of these types counted rows stand for."""
    return F.sum(F.when(is_type(*types), F.col("n")).otherwise(F.lit(0)))


def is_type(*types: str) -> Column:
    return F.col("event_type").isin(*types)


def owner_of(repo_name: str | Column) -> Column:
    name = F.col(repo_name) if isinstance(repo_name, str) else repo_name
    return F.split_part(name, F.lit("/"), F.lit(1))


def per(amount: Column, base: Column) -> Column:
    """`amount / base` as a double, null when the base is zero or null."""
    return amount.cast("double") / F.nullif(base, F.lit(0))


def first_reached(value: Column, bounds: list[tuple[str, float | None]]) -> Column:
    """The first label whose lower bound `value` reaches; a null value reaches none."""
    *levels, (otherwise, _) = bounds
    label = F.lit(otherwise)
    for name, bound in reversed(levels):
        label = F.when(value >= F.lit(bound), F.lit(name)).otherwise(label)
    return label


def hour_start(time: str) -> Column:
    """A wall-clock time cut to its hour, without going through the session time zone."""
    return F.to_date(time).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(time))


def hour_key(time: str | Column) -> Column:
    """`yyyy-MM-dd-H`, the hour without a leading zero."""
    return F.concat_ws("-", F.to_date(time).cast("string"), F.hour(time).cast("string"))


def utc_wall_clock(instant: Column) -> Column:
    """A zoned timestamp as UTC wall-clock time, whatever the session time zone."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def as_instant(events: DataFrame, column: str) -> Column:
    """The column as a zoned timestamp, the only type a watermark accepts.

    A wall-clock time is taken as UTC, whatever the session time zone.
    """
    if isinstance(events.schema[column].dataType, T.TimestampType):
        return F.col(column)
    since_epoch = F.col(column) - F.lit(EPOCH).cast("timestamp_ntz")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), since_epoch)

    minutes = (part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return F.timestamp_seconds(minutes * 60 + part("SECOND"))
