"""How each model is stored: staging as views, the others as tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgepulse.operators.staging import staging_views
from forgepulse.sources.versions import Conflict, Version
from forgepulse.sources.warehouse import EVENT_SEGMENTS, Warehouse

ACTIVITY = "int_repo_daily_activity"
# Not a model of its own: the plain daily counts others are built from.
SIGNALS = "int_repo_daily_signals"
# Nor this one: per day who did what where, which windows of distinct counts are merged from.
PAIRS = "int_daily_pairs"
# Hourly activity of all events, kept by a stream.
HOURS = "int_hourly_activity"
BY_DATE = {ACTIVITY, SIGNALS, PAIRS, HOURS}

# The order a report is read in, and stored by: each chunk holds a range of it.
READ_ORDER = {
    "mart_trending_repos": [F.desc, "activity_date", "activity_score"],
    "mart_ai_ecosystem": [F.desc, "score_this_week"],
    "mart_ecosystem_hourly": [F.desc, "activity_hour", "event_count"],
    "mart_org_scoreboard": [F.desc, "total_events"],
    "mart_contributor_migration": [F.desc, "org_count", "total_cross_org_events"],
    "mart_fork_conversion": [F.desc, "fork_to_pr_conversion", "fork_count"],
    "mart_release_momentum": [F.desc, "release_count", "prs_per_release"],
    "mart_new_repo_breakout": [F.desc, "total_activity_score"],
    "mart_viral_velocity": [F.desc_nulls_last, "velocity_ratio"],
}


CHUNK = "chunk"
# Up to so many chunks are read one after the other; more are sorted anew.
CHUNKS_IN_TURN = 64


def reading_order(model: str) -> list[Column]:
    direction, *columns = READ_ORDER[model]
    return [direction(name) for name in columns]


def layer_of(model: str) -> str:
    return "intermediate" if model.startswith("int_") else "marts"


def create_views(events: DataFrame) -> list[str]:
    views = staging_views(events)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)


class Build:
    """Models written by one run, of which no reader sees any before `publish` shows all.

    Events and metadata are those of the version the run began with.
    """

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse.pinned()
        self.written: dict[str, dict] = {}
        self.only_dates: dict[str, list[str] | None] = {}
        self.taken_in: list[str] = []

    def write(self, model: str, df: DataFrame, only_dates: list[date] | None = None) -> DataFrame:
        """Writes a model and returns it as it will be read.

        Daily tables are partitioned by date; with `only_dates`, `df` holds those dates
        only and the others stay.
        """
        name, rows, partition_by, schema = _table(model), df, None, df.schema
        if model in BY_DATE:
            partition_by = "activity_date"
            rows = df.hint("rebalance", partition_by)
        elif model in READ_ORDER:
            # The chunk is each task's number, so the rows stay in the order of their range.
            partition_by, order = CHUNK, reading_order(model)
            rows = df.repartitionByRange(*order).withColumn(CHUNK, F.spark_partition_id())
            rows = rows.sortWithinPartitions(CHUNK, *order)
        segment = self.warehouse.write_segment(name, rows, [partition_by] if partition_by else [])
        values = self.warehouse.partitions_of(name, segment) if partition_by else []
        entry = {"schema": schema.jsonValue(), "partition_by": partition_by, "segments": {segment: values}}
        if partition_by == CHUNK:
            stored = T.StructType([*schema.fields, T.StructField(CHUNK, T.IntegerType())])
            counted = self.warehouse.read_segments(name, stored, entry["segments"], CHUNK).groupBy(CHUNK).count()
            entry["rows"] = {str(row[CHUNK]): row["count"] for row in counted.collect()}
        self.written[name] = entry
        self.only_dates[name] = None if only_dates is None else [day.isoformat() for day in only_dates]
        return self.read(model).select(*df.columns)

    def read(self, model: str) -> DataFrame:
        """A model as this run leaves it."""
        name = _table(model)
        entry = self.written.get(name)
        if entry is None:
            return read_model(self.warehouse, model)
        return self.warehouse.read_entry(name, self._merged(name, self.warehouse.version().get(name)))

    def _merged(self, name: str, before: dict) -> dict:
        """The model's entry: dates this run has not rebuilt stay in their segments."""
        entry, dates = self.written[name], self.only_dates[name]
        if dates is None:
            return entry
        kept = {
            segment: [day for day in days if day not in set(dates)]
            for segment, days in before.get("segments", {}).items()
        }
        kept = {segment: days for segment, days in kept.items() if days}
        return entry | {"segments": kept | entry["segments"]}

    def publish(self) -> None:
        """Shows all models written in one step, and marks the events the daily tables took in.

        If another run published a daily table meanwhile, dates rebuilt here on its former
        state would not fit, and nothing is published.
        """
        base = self.warehouse.version()

        def change(content: dict, now: Version) -> None:
            for name, entry in self.written.items():
                if self.only_dates[name] is not None and now.get(name) != base.get(name):
                    raise Conflict(f"{name} was published meanwhile")
                content[name] = self._merged(name, now.get(name)) if self.only_dates[name] is not None else entry
            for segment in self.taken_in:
                if segment in content.get(EVENT_SEGMENTS, {}):
                    content[EVENT_SEGMENTS][segment]["pending"] = []

        self.warehouse.publish(change)

    def drop(self) -> None:
        """Deletes what was written, after a run that failed."""
        for name, entry in self.written.items():
            for segment in entry["segments"]:
                self.warehouse.drop_segment(name, segment)


def write_model(
    warehouse: Warehouse, model: str, df: DataFrame, only_dates: list[date] | None = None
) -> DataFrame:
    """Rebuilds one model's table, publishes it and returns it as stored."""
    build = Build(warehouse)
    stored = build.write(model, df, only_dates)
    build.publish()
    return stored


def is_built(warehouse: Warehouse, model: str) -> bool:
    return bool(warehouse.version().get(_table(model)))


def read_model(
    warehouse: Warehouse, model: str, ordered: bool = False, top: int | None = None
) -> DataFrame:
    """A model as stored; with `ordered`, in its reading order, and with `top` its first rows.

    A report's chunks are ranges of its order, so they are read one after the other, each
    sorted within its tasks: nothing is shuffled, and for the first rows only as many chunks
    are read as hold them.
    """
    if not (ordered or top is not None) or model not in READ_ORDER:
        return warehouse.read(_table(model))
    name, order = _table(model), reading_order(model)
    entry = warehouse.version().get(name)
    if not entry:
        raise KeyError(f"{model} was never built")
    (segment, values), = entry["segments"].items()
    chunks, rows = [], 0
    for value in sorted(values, key=int):
        if top is not None and rows >= top:
            break
        chunks.append(value)
        rows += entry["rows"][value]
    if len(chunks) > CHUNKS_IN_TURN or not chunks:
        return _first(warehouse.read_entry(name, entry | {"segments": {segment: chunks}}).orderBy(*order), top)
    in_turn = [
        warehouse.read_entry(name, entry | {"segments": {segment: [chunk]}}).sortWithinPartitions(*order)
        for chunk in chunks
    ]
    return _first(reduce(DataFrame.unionByName, in_turn), top)


def _first(rows: DataFrame, top: int | None) -> DataFrame:
    return rows if top is None else rows.limit(top)


def _table(model: str) -> str:
    return f"{layer_of(model)}/{model}"
