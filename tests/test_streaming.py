"""Streams against their batch forms."""

from __future__ import annotations

import gzip
import random
from datetime import datetime, timedelta

import pytest
from conftest import collected, event, frame
from pyspark.sql import functions as F
from test_jobs import land, landed

from forgepulse.clock import AsOf
from forgepulse.functions.events import as_instant, hour_key, hour_start, utc_wall_clock
from forgepulse.operators.community import mart_ecosystem_hourly
from forgepulse.schema import EVENTS
from forgepulse.operators.ingestion import ingest_hours
from forgepulse.plans.pipeline import run_pipeline
from forgepulse.plans.layers import HOURS, read_model
from forgepulse.sources.warehouse import Warehouse
from forgepulse.streaming.hourly import keep_hours, stream_hourly
from forgepulse.streaming.ingest import load_available, write_available


def _run(stream, tmp_path):
    write_available(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_stream_equals_the_load_for_any_batching(spark, tmp_path, as_of, max_files):
    folder = tmp_path / "landing"
    folder.mkdir()
    streamed, loaded = (Warehouse(spark, str(tmp_path / name)) for name in ("streamed", "loaded"))

    def run():
        load_available(
            streamed, str(folder), as_of, str(tmp_path / "state"), max_files
        ).awaitTermination()
        return collected(streamed.events(), "event_id")

    land(folder, "2024-01-31-5", landed(1), landed(1), landed(2, at="2024-01-31T09:00:00Z"), "{broken")
    land(folder, "2024-01-31-6", landed(5, at="2024-01-31T06:00:00Z"))
    assert run() == [1, 2, 5]
    # A repeated id, and events days older than those stored.
    land(
        folder, "2024-01-31-9", landed(2, at="2024-01-31T09:00:00Z"),
        landed(3, at="2024-01-21T05:00:00Z"), landed(4, at="2024-01-31T08:30:00Z"),
    )
    assert run() == [1, 2, 3, 4, 5]
    ingest_hours(loaded, str(folder), ["2024-01-31-5", "2024-01-31-6", "2024-01-31-9"], as_of)
    for table in ("events", "ledger", "quarantine"):
        frames = [getattr(warehouse, table)() for warehouse in (streamed, loaded)]
        names = [name for name in frames[0].columns if name != "loaded_at"]
        assert collected(frames[0], *names) == collected(frames[1], *names)


@pytest.mark.parametrize("max_files", [1, 2, 3, None])
def test_any_split_of_an_hour_equals_the_load(spark, tmp_path, as_of, max_files):
    """Several files an hour with an unusable record each, some of them landing later."""
    folder = tmp_path / "landing"
    streamed, loaded = (Warehouse(spark, str(tmp_path / name)) for name in ("streamed", "loaded"))

    def put(hour, part, *lines):
        (folder / f"hour_key=2024-01-31-{hour}").mkdir(parents=True, exist_ok=True)
        with gzip.open(folder / f"hour_key=2024-01-31-{hour}" / f"part-{part}.json.gz", "wt") as file:
            file.write("\n".join([*lines, f"{{broken {hour} {part}"]) + "\n")

    def run():
        load_available(
            streamed, str(folder), as_of, str(tmp_path / "state"), max_files
        ).awaitTermination()

    for part in range(3):
        for hour in (5, 6):
            put(hour, part, landed(100 * hour + part), landed(100 * hour + part), landed(7, at="2024-01-31T05:00:00Z"))
    run()
    assert set(collected(streamed.ledger(), "status")) == {"loaded"}
    put(6, 3, landed(604), landed(7, at="2024-01-31T05:00:00Z"))
    put(7, 0)
    run()
    # The same file again, repaired: a load of the hour takes it in.
    ingest_hours(loaded, str(folder), [f"2024-01-31-{hour}" for hour in (5, 6, 7)], as_of)
    for table in ("events", "ledger", "quarantine"):
        frames = [getattr(warehouse, table)() for warehouse in (streamed, loaded)]
        names = [name for name in frames[0].columns if name not in ("loaded_at", "source_file")]
        assert collected(frames[0], *names) == collected(frames[1], *names)
    assert streamed.quarantine().count() == 8
    assert collected(streamed.ledger(), "hour_key", "row_count") == [
        ("2024-01-31-5", 6), ("2024-01-31-6", 8), ("2024-01-31-7", 0),
    ]


def test_an_hour_is_partial_until_its_files_are_loaded(spark, tmp_path, as_of):
    folder = tmp_path / "landing"
    folder.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    hour = folder / "hour_key=2024-01-31-5"
    hour.mkdir()
    with gzip.open(hour / "a.json.gz", "wt") as file:
        file.write(landed(1) + "\n")
    with gzip.open(hour / "empty.json.gz", "wt") as file:
        file.write("")
    load_available(warehouse, str(folder), as_of, str(tmp_path / "state")).awaitTermination()
    assert collected(warehouse.ledger(), "status") == ["partial"]
    run_pipeline(warehouse, as_of, str(folder))
    assert collected(warehouse.ledger(), "status", "row_count") == [("loaded", 1)]


def test_daily_tables_take_in_what_others_loaded(spark, tmp_path, as_of):
    folder = tmp_path / "landing"
    folder.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    # Nothing has landed: every model is there, and empty.
    models = run_pipeline(warehouse, as_of, str(folder))
    assert len(models) == 20
    assert all(read_model(warehouse, name).isEmpty() for name in models if not name.startswith("stg_"))
    land(folder, "2024-01-31-5", landed(1, at="2024-01-31T05:00:00Z"))
    run_pipeline(warehouse, as_of, str(folder))
    land(folder, "2024-01-31-6", landed(2, at="2024-01-31T06:00:00Z"))
    ingest_hours(warehouse, str(folder), ["2024-01-31-6"], as_of)
    land(folder, "2024-01-31-7", landed(3, at="2024-01-30T07:00:00Z"))
    load_available(warehouse, str(folder), as_of, str(tmp_path / "state")).awaitTermination()
    run_pipeline(warehouse, as_of, str(folder))
    whole = Warehouse(spark, str(tmp_path / "whole"))
    run_pipeline(whole, as_of, str(folder))
    for name in models:
        if not name.startswith("stg_"):
            columns = read_model(whole, name).columns
            assert collected(read_model(warehouse, name), *columns) == collected(read_model(whole, name), *columns)
    assert warehouse.touched() == {}


@pytest.fixture(params=["UTC", "Asia/Kolkata"])
def time_zone(spark, request):
    """A session time zone, which must not matter."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_times_are_utc_in_any_session(spark, time_zone):
    events = frame(spark, [event("Push", at=datetime(2024, 3, 31, 2, 30, 0, 123456))])
    instant = as_instant(events, "created_at")
    row = events.select(
        F.unix_micros(instant).alias("micros"), utc_wall_clock(instant).alias("again"),
        hour_start("created_at").alias("hour"), hour_key("created_at").alias("key"),
    ).first()
    assert row.micros == 1711852200123456 and row.again == datetime(2024, 3, 31, 2, 30, 0, 123456)
    assert row.hour == datetime(2024, 3, 31, 2) and row.key == "2024-03-31-2"


def test_stream_hours_equal_batch_hours(spark, tmp_path, time_zone):
    start = datetime(2024, 1, 31)
    rows = [
        event(kind, repo=n % 5, actor=None if n % 11 == 0 else n % 7, at=start + timedelta(minutes=7 * n))
        for n in range(120) for kind in ("Push", "Watch") if n % 3 or kind == "Push"
    ]
    source = str(tmp_path / "events")
    frame(spark, rows).write.parquet(source)
    stream = stream_hourly(spark.readStream.schema(EVENTS).parquet(source), "1 hour")
    _run(stream, tmp_path)
    # The last event is at 13:53, the watermark at 12:53, so 11:00 is the last closed hour.
    batch = mart_ecosystem_hourly(frame(spark, rows), AsOf(start + timedelta(days=2))).where(
        F.col("activity_hour") < F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    )
    columns = batch.columns
    assert collected(spark.read.parquet(str(tmp_path / "out")), *columns) == collected(batch, *columns)


def test_stream_hours_drop_what_comes_after_the_watermark(spark, tmp_path):
    source = str(tmp_path / "events")
    start = datetime(2024, 1, 31)

    def add(*minutes):
        frame(spark, [event("Push", at=start + timedelta(minutes=m)) for m in minutes]).write.mode(
            "append"
        ).parquet(source)
        _run(stream_hourly(spark.readStream.schema(EVENTS).parquet(source), "1 hour"), tmp_path)
        stored = spark.read.schema(
            "activity_hour timestamp_ntz, event_type string, event_count bigint"
        ).parquet(str(tmp_path / "out"))
        return collected(stored, "activity_hour", "event_count")

    assert add(10, 20, 150) == [(start, 2)]
    # The hour at 00:00 is closed; the one at 01:00 is still open.
    assert add(30, 100, 300) == [(start, 2), (start + timedelta(hours=1), 1), (start + timedelta(hours=2), 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_hours_are_corrected_in_any_order(spark, tmp_path, seed):
    """Late events, hot hours, repeated runs: always the hourly report of all that is there."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 30, 22)
    rows = [
        event(rng.choice(["Push", "Watch"]), repo=rng.choice([None, 1, 2, 3]), actor=rng.choice([None, 1, 2, 3, 4]),
              at=start + timedelta(minutes=rng.randint(0, 300)))
        for _ in range(160)
    ]
    source, warehouse = str(tmp_path / "events"), Warehouse(spark, str(tmp_path / "warehouse"))
    for at in range(0, 160, 40):
        frame(spark, rows[at:at + 40]).coalesce(2).write.mode("append").partitionBy("event_date").parquet(source)
        for _ in range(2):
            keep_hours(warehouse, source, str(tmp_path / "state"), max_files=1).awaitTermination()
        hours = read_model(warehouse, HOURS)
        whole = mart_ecosystem_hourly(frame(spark, rows[:at + 40]), AsOf(start + timedelta(days=1)))
        assert collected(hours, *whole.columns) == collected(whole, *whole.columns)
    assert set(collected(hours, "activity_date")) == {row["event_date"] for row in rows}
