"""Loading, enrichment, quality checks and the whole run."""

from __future__ import annotations

import gzip
import json
import random
from datetime import date, datetime, timedelta
from multiprocessing.pool import ThreadPool

import pytest
from conftest import NOW, by_key, collected, days_ago, event, frame, metadata
from pyspark.sql import Observation
from pyspark.sql import functions as F

from forgepulse import binding
from forgepulse.clock import AsOf
from forgepulse.functions.events import hour_key
from forgepulse.operators.activity import activity_of_events
from forgepulse.operators.enrichment import (
    enrichment_candidates, merge_metadata, metadata_upsert, upsert_metadata,
)
from forgepulse.operators.ingestion import (
    NullsFound, backfill_hours, hours_between, ingest_hour, ingest_hours, loaded_intervals,
    pending_hours, pending_intervals,
)
from forgepulse.operators.quality import dq_not_null, observe_nulls
from forgepulse.operators.trending import mart_trending_repos
from forgepulse.plans.layers import ACTIVITY, READ_ORDER, read_model, write_model
from forgepulse.plans.pipeline import run_pipeline
from forgepulse.plans.upkeep import compact_events, compact_files
from forgepulse.schema import EVENT_COLUMNS, LEDGER
from forgepulse.sources.versions import Versions
from forgepulse.sources.warehouse import BUCKETS, Warehouse, hour_frame

DATA = "/root/testdata/sf0.001"


def landed(event_id, kind="WatchEvent", at="2024-01-31T05:10:00Z", **other):
    record = {
        "id": str(event_id), "type": kind, "actor": {"id": 1, "login": "one"},
        "repo": {"id": 7, "name": "own/r7"}, "created_at": at,
    }
    return json.dumps(record | other)


def land(folder, key, *lines):
    with gzip.open(folder / f"{key}.json.gz", "wt") as file:
        file.write("\n".join(lines) + "\n")


@pytest.fixture
def store(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    return warehouse, tmp_path / "landing"


def test_hour_keys_have_no_leading_zero(spark):
    times = spark.sql("select timestamp_ntz '2024-01-01 05:59:59' t union all select timestamp_ntz '2024-12-31 23:00:00'")
    assert sorted(row[0] for row in times.select(hour_key("t")).collect()) == ["2024-01-01-5", "2024-12-31-23"]


def test_backfill_range_is_inclusive_and_may_be_empty(spark):
    keys = [row.hour_key for row in backfill_hours(spark, "2024-03-31", date(2024, 4, 1)).collect()]
    assert len(keys) == 48 and keys[0] == "2024-03-31-0" and keys[-1] == "2024-04-01-23"
    assert backfill_hours(spark, "2024-04-02", "2024-04-01").count() == 0


def test_ingest_reads_fields(store, as_of):
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1, org={"id": 9, "login": "org"}), landed(2, at="2024-01-31T05:10:00.5+02:00"))
    ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
    rows = by_key(warehouse.events(), "event_id", *EVENT_COLUMNS[1:], "event_date")
    assert rows[1] == (
        "WatchEvent", 1, "one", 7, "own/r7", 9, "org", datetime(2024, 1, 31, 5, 10), "2024-01-31-5",
        date(2024, 1, 31),
    )
    assert rows[2][5:8] == (None, None, datetime(2024, 1, 31, 3, 10, 0, 500000))


def test_loading_twice_changes_nothing(store, as_of):
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1), landed(2), landed(2))
    land(folder, "2024-01-31-6", landed(2), landed(3), "{not json", json.dumps({"id": "x", "type": "PushEvent"}))
    keys = ["2024-01-31-5", "2024-01-31-6", "2024-01-31-7"]
    for _ in range(2):
        ingest_hours(warehouse, str(folder), keys, as_of)
        assert collected(warehouse.events(), "event_id", "source_file") == [
            (1, "2024-01-31-5"), (2, "2024-01-31-5"), (3, "2024-01-31-6"),
        ]
        assert collected(warehouse.ledger(), "hour_key", "row_count", "status") == [
            ("2024-01-31-5", 2, "loaded"), ("2024-01-31-6", 2, "loaded"),
        ]
        records = collected(warehouse.quarantine(), "hour_key", "record")
        assert [key for key, _ in records] == ["2024-01-31-6"] * 2
        assert any("{not json" in record for _, record in records)
    assert collected(pending_hours(hour_frame(warehouse.spark, keys), warehouse.ledger()), "hour_key") == [
        "2024-01-31-7"
    ]


def test_a_load_that_fails_before_it_publishes_leaves_nothing(store, as_of, monkeypatch):
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1), "{not json")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
    for table in (warehouse.events(), warehouse.ledger(), warehouse.quarantine()):
        assert table.isEmpty()
    load = ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
    assert load.dates == [date(2024, 1, 31)]
    assert warehouse.events().count() == 1 and warehouse.ledger().count() == 1
    # What the first try wrote is no version's; recent folders are left to running loads.
    assert warehouse.vacuum() == []
    gone = warehouse.vacuum(older_than=0)
    assert len(gone) == 3 and warehouse.vacuum(older_than=0) == []
    assert warehouse.events().count() == 1 and warehouse.quarantine().count() == 1


@pytest.mark.parametrize("seed", range(6))
def test_intervals_equal_the_anti_join(spark, seed):
    """Ledgers with holes, full days, repeated entries, failures, and hours outside."""
    rng = random.Random(seed)
    start = datetime(2024, 2, 27)
    hours = [start + timedelta(hours=n) for n in range(24 * 5)]
    share = [0, 0.1, 0.5, 0.9, 0.97, 1][seed]
    rows = [
        (f"{hour:%Y-%m-%d}-{hour.hour}", 1, NOW, rng.choice(["loaded", "loaded", "loaded", "partial"]) if share < 1 else "loaded")
        for hour in hours for _ in range(rng.randint(1, 2)) if rng.random() < share
    ]
    ledger = spark.createDataFrame(rows, LEDGER)
    days = spark.sql("select date'2024-02-28' first, date'2024-03-01' last")
    expected = sorted(pending_hours(hours_between(days, F.col("first"), F.col("last")), ledger).collect())
    found = pending_intervals(days, F.col("first"), F.col("last"), loaded_intervals(ledger)).collect()
    keys = [
        f"{hour:%Y-%m-%d}-{hour.hour}" for row in found for n in range(row.hours)
        for hour in [row.first_hour + timedelta(hours=n)]
    ]
    assert sorted(keys) == [row.hour_key for row in expected]
    assert all(row.last_hour - row.first_hour == timedelta(hours=row.hours - 1) for row in found)
    ends = sorted((row.first_hour, row.last_hour) for row in found)
    assert all(b[0] - a[1] > timedelta(hours=1) for a, b in zip(ends, ends[1:]))


def test_event_in_a_later_load_is_not_stored_again(store, as_of):
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1))
    land(folder, "2024-01-31-6", landed(1), landed(4, at="2024-01-30T00:00:00Z"))
    for key in ("2024-01-31-5", "2024-01-31-6"):
        ingest_hour(warehouse, str(folder), key, as_of)
    assert collected(warehouse.events(), "event_id", "event_date") == [
        (1, date(2024, 1, 31)), (4, date(2024, 1, 30)),
    ]


def test_nulls_are_counted_in_what_landed(store, as_of):
    """Rows with nulls are stored and reported where that is asked for, and only there."""
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1), landed(2, kind=None), landed(3, repo={"id": 1}))
    expected = {"event_id": 0, "event_type": 1, "repo_name": 1}
    for _ in range(2):
        load = ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of, only_report_nulls=True)
        assert load.null_failures == expected
    with pytest.raises(NullsFound):
        ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
    assert warehouse.events().count() == 3


def test_nulls_keep_a_load_from_being_published_however_often_it_is_tried(store, as_of):
    warehouse, folder = store
    land(folder, "2024-01-31-4", landed(1, at="2024-01-31T04:00:00Z"))
    ingest_hour(warehouse, str(folder), "2024-01-31-4", as_of)
    before = warehouse.version()
    land(folder, "2024-01-31-5", landed(2, kind=None), landed(3), "{not json")
    for _ in range(3):
        with pytest.raises(NullsFound, match="event_type"):
            ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
        with pytest.raises(NullsFound):
            run_pipeline(warehouse, as_of, str(folder))
        assert warehouse.version() == before
    assert collected(warehouse.events(), "event_id") == [1] and warehouse.quarantine().isEmpty()
    # The repaired file passes, and its former unusable record is gone.
    land(folder, "2024-01-31-5", landed(2), landed(3))
    ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
    assert collected(warehouse.events(), "event_id") == [1, 2, 3]
    assert collected(warehouse.ledger(), "hour_key", "row_count", "status") == [
        ("2024-01-31-4", 1, "loaded"), ("2024-01-31-5", 2, "loaded"),
    ]


def test_a_repaired_file_loses_its_old_unusable_records(store, as_of):
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1), "{not json")
    land(folder, "2024-01-31-6", landed(2), "{nor this")
    keys = ["2024-01-31-5", "2024-01-31-6"]
    ingest_hours(warehouse, str(folder), keys, as_of)
    assert collected(warehouse.quarantine(), "hour_key") == keys
    land(folder, "2024-01-31-5", landed(1), landed(9))
    ingest_hour(warehouse, str(folder), keys[0], as_of)
    assert collected(warehouse.quarantine(), "hour_key") == keys[1:]
    assert collected(warehouse.ledger(), "row_count") == [1, 2]
    compact_files(warehouse)
    assert collected(warehouse.quarantine(), "hour_key") == keys[1:]
    assert collected(warehouse.ledger(), "row_count") == [1, 2]
    assert len(warehouse.version().get("raw/files")) == 1


def test_loads_side_by_side_store_each_event_once(spark, store, as_of, tmp_path):
    """Overlapping hours, and events of one date in all of them."""
    warehouse, folder = store
    keys = [f"2024-01-31-{hour}" for hour in range(6)]
    for hour, key in enumerate(keys):
        land(folder, key, *[landed(n, at="2024-01-30T23:00:00Z") for n in range(hour * 2, hour * 2 + 5)])
    loads = [keys[:3], keys[1:4], keys[2:], keys]
    with ThreadPool(4) as pool:
        pool.map(lambda own: ingest_hours(warehouse, str(folder), own, as_of), loads, chunksize=1)
    assert collected(warehouse.events(), "event_id") == list(range(15))
    single = Warehouse(spark, str(tmp_path / "single"))
    ingest_hours(single, str(folder), keys, as_of)
    assert collected(warehouse.ledger(), "hour_key", "row_count", "status") == collected(
        single.ledger(), "hour_key", "row_count", "status"
    )


def test_a_load_that_was_second_compares_its_ids_anew(store, as_of, monkeypatch):
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1), landed(2))
    land(folder, "2024-01-31-6", landed(2), landed(3))
    write, first = Warehouse.write_events, []

    def meanwhile(self, events):
        segment = write(self, events)
        if not first:
            first.append(segment)
            ingest_hour(Warehouse(self.spark, self.root), str(folder), "2024-01-31-6", as_of)
        return segment

    monkeypatch.setattr(Warehouse, "write_events", meanwhile)
    ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
    assert collected(warehouse.events(), "event_id", "source_file") == [
        (1, "2024-01-31-5"), (2, "2024-01-31-6"), (3, "2024-01-31-6"),
    ]
    assert first[0] not in warehouse.version().get("raw/events")


def test_only_one_commit_takes_a_number(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "versions"))

    def add(name):
        return versions.commit(lambda now: now.content | {name: now.number}).number

    with ThreadPool(8) as pool:
        numbers = pool.map(add, [str(n) for n in range(24)], chunksize=1)
    assert sorted(numbers) == list(range(1, 25))
    assert sorted(versions.current().content.values()) == list(range(24))
    assert [version.number for version in versions.forget(2)] == [23, 24]
    assert versions.numbers() == [23, 24] and versions.current().number == 24


def test_compaction_beside_loads(store, as_of, monkeypatch):
    """Rows stay, files become few, a load in between is kept, daily tables take in all."""
    warehouse, folder = store
    for hour in range(6):
        land(folder, f"2024-01-31-{hour}", *[landed(10 * hour + n, at=f"2024-01-{30 + n % 2}T0{hour}:00:00Z") for n in range(4)])
        if hour < 5:
            ingest_hour(warehouse, str(folder), f"2024-01-31-{hour}", as_of)
        if hour == 1:
            run_pipeline(warehouse, as_of)
    pinned, before = warehouse.pinned(), collected(warehouse.events(), *EVENT_COLUMNS)
    write, loaded = Warehouse.write_events, []

    def meanwhile(self, events):
        segment = write(self, events)
        if not loaded:
            loaded.append(segment)
            ingest_hour(Warehouse(self.spark, self.root), str(folder), "2024-01-31-5", as_of)
        return segment

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "write_events", meanwhile)
        assert compact_events(warehouse, segments=2) == [date(2024, 1, 30), date(2024, 1, 31)]
    assert len(warehouse.version().get("raw/events")) == 2
    assert len(collected(warehouse.events(), "event_id")) == 24
    assert collected(pinned.events(), *EVENT_COLUMNS) == before
    assert compact_events(warehouse, segments=2) == []
    run_pipeline(warehouse, as_of)
    stored, full = read_model(warehouse, ACTIVITY), activity_of_events(warehouse.events())
    assert stored.select(*full.columns).exceptAll(full).isEmpty() and stored.count() == full.count()
    assert warehouse.touched() == {}
    # Two compactions of the same dates: one is first, the other leaves them.
    for event_id, hour in ((90, 7), (91, 8)):
        land(folder, f"2024-01-31-{hour}", landed(event_id))
        ingest_hour(warehouse, str(folder), f"2024-01-31-{hour}", as_of)
    with ThreadPool(2) as pool:
        done = pool.map(lambda _: compact_events(warehouse, segments=1), range(2), chunksize=1)
    assert collected(warehouse.events(), "event_id")[-2:] == [90, 91] and any(done)
    assert len(collected(warehouse.events(), "event_id")) == 26


def test_models_are_shown_together(spark, store, as_of, monkeypatch):
    """While a rebuild runs, and after one that fails, every report is the former one."""
    warehouse, folder = store
    land(folder, "2024-01-30-5", *[landed(n, at="2024-01-30T05:00:00Z") for n in range(6)])
    models = [name for name in run_pipeline(warehouse, as_of, str(folder)) if not name.startswith("stg_")]
    assert len(models) == 13
    before = {name: collected(read_model(warehouse, name), *read_model(warehouse, name).columns) for name in models}
    version = warehouse.version()
    land(folder, "2024-01-31-6", landed(20), landed(21))
    seen = []

    def fail(*_):
        seen.append({name: collected(read_model(warehouse, name), *read_model(warehouse, name).columns) for name in models})
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr("forgepulse.plans.pipeline.mart_contributor_migration", fail)
        with pytest.raises(RuntimeError, match="lost"):
            run_pipeline(warehouse, as_of, str(folder))
    assert seen == [before]
    assert {name: warehouse.version().get(name) for name in version.content if not name.startswith("raw")} == {
        name: value for name, value in version.content.items() if not name.startswith("raw")
    } | {"last_loaded": warehouse.version().get("last_loaded")}
    reader = warehouse.pinned()
    run_pipeline(warehouse, as_of)
    assert {name: collected(read_model(reader, name), *read_model(reader, name).columns) for name in models} == before
    assert collected(read_model(warehouse, ACTIVITY), "activity_date", "stars") == [
        (date(2024, 1, 30), 6), (date(2024, 1, 31), 2),
    ]


def test_backfill_equals_the_hours_one_by_one(spark, store, tmp_path, as_of):
    warehouse, folder = store
    keys = []
    for hour in range(4):
        keys.append(f"2024-01-31-{hour}")
        land(folder, keys[-1], *[landed(n, at=f"2024-01-31T0{hour}:00:00Z") for n in range(hour * 3, hour * 3 + 4)])
    ingest_hours(warehouse, str(folder), keys, as_of)
    single = Warehouse(spark, str(tmp_path / "single"))
    for key in keys:
        ingest_hour(single, str(folder), key, as_of)
    ids = collected(warehouse.events(), "event_id", "source_file")
    assert ids == collected(single.events(), "event_id", "source_file") and len(ids) == 13
    assert collected(warehouse.ledger(), "hour_key", "row_count") == collected(single.ledger(), "hour_key", "row_count")


def test_windowed_reads_prune_partitions(store, as_of):
    warehouse, folder = store
    land(folder, "2024-01-31-5", landed(1), landed(2, at="2023-01-01T00:00:00Z"))
    ingest_hour(warehouse, str(folder), "2024-01-31-5", as_of)
    activity = write_model(warehouse, ACTIVITY, activity_of_events(warehouse.events()))
    plan = mart_trending_repos(activity, as_of)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(activity_date" in plan


def test_enrichment_candidates(spark, as_of):
    rows = [
        *[event("Push", repo=1) for _ in range(3)],
        *[event("Watch", repo=2) for _ in range(5)],
        *[event("Watch", repo=3) for _ in range(4)],
        event("Push", repo=4, name="a/old", at=days_ago(2)), event("Push", repo=4, name="a/new"),
        *[event("Push", repo=5, at=days_ago(8)) for _ in range(9)],
        event("Push", repo=6), event("Push", repo=None, name="x/y"),
    ]
    records = metadata(
        spark,
        {"repo_id": 2, "fetched_at": NOW - timedelta(days=1)},
        {"repo_id": 3, "fetched_at": NOW - timedelta(days=8)},
    )
    best = enrichment_candidates(frame(spark, rows), records, as_of, batch=3)
    assert [tuple(row) for row in best.collect()] == [(3, "own/r3", 4), (1, "own/r1", 3), (4, "a/new", 2)]


def test_upsert_keeps_the_latest_record(spark):
    day = timedelta(days=1)
    current = metadata(
        spark,
        {"repo_id": 1, "stargazers_count": 1, "fetched_at": NOW - day},
        {"repo_id": 2, "stargazers_count": 2, "fetched_at": NOW},
        {"repo_id": 3, "stargazers_count": 3, "fetched_at": NOW},
        {"repo_id": 5, "stargazers_count": 5, "fetched_at": None},
    )
    records = metadata(
        spark,
        {"repo_id": 1, "stargazers_count": 10, "topics": ["new"], "fetched_at": NOW},
        {"repo_id": 1, "stargazers_count": 11, "fetched_at": NOW - 2 * day},
        {"repo_id": 2, "stargazers_count": 20, "fetched_at": NOW - day},
        {"repo_id": 3, "stargazers_count": 0, "fetched_at": NOW},
        {"repo_id": 4, "stargazers_count": 4, "fetched_at": NOW},
        {"repo_id": None, "stargazers_count": 6, "fetched_at": NOW},
    )
    merged = metadata_upsert(current, records)
    assert collected(merged, "repo_id", "stargazers_count") == [(1, 10), (2, 2), (3, 0), (4, 4), (5, 5)]


def test_metadata_are_merged_by_bucket(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.metadata().count() == 0 and merge_metadata(warehouse) == []

    def record(repo, stars):
        return {"repo_id": repo, "stargazers_count": stars, "fetched_at": NOW + timedelta(stars)}

    upsert_metadata(warehouse, metadata(spark, *[record(repo, 1) for repo in range(500)]))
    pinned = warehouse.pinned()
    assert merge_metadata(warehouse) == [str(n) for n in range(BUCKETS)]
    before = warehouse.version().get("raw/metadata")
    upsert_metadata(warehouse, metadata(spark, record(7, 3), record(8, 0), record(900, 2)))
    upsert_metadata(warehouse, metadata(spark, record(7, 2), {"repo_id": None}))
    wanted = [(repo, {7: 3, 900: 2}.get(repo, 1)) for repo in [*range(500), 900]]
    assert collected(warehouse.metadata(), "repo_id", "stargazers_count") == wanted
    touched = merge_metadata(warehouse)
    assert 1 <= len(touched) <= 3
    after = warehouse.version().get("raw/metadata")
    assert {name for name in after if after[name] != before[name]} == set(touched)
    assert collected(warehouse.metadata(), "repo_id", "stargazers_count") == wanted
    assert set(collected(pinned.metadata(), "stargazers_count")) == {1}
    assert warehouse.vacuum(keep=1, older_than=0) and collected(warehouse.metadata(), "repo_id") == [*range(500), 900]


def test_null_checks(spark, tmp_path):
    rows = [event("Push"), event("Push") | {"repo_name": None}, event(None)]
    failures = {"event_id": 0, "event_type": 1, "repo_name": 1}
    report = dq_not_null(frame(spark, rows), "events")
    assert {row.column_name: row.failures for row in report.collect()} == failures
    observation = Observation()
    observe_nulls(frame(spark, rows), observation).write.parquet(str(tmp_path / "out"))
    assert observation.get == failures


@pytest.mark.parametrize("model", list(READ_ORDER))
def test_read_order_names_known_models(model):
    assert model.startswith("mart_") and callable(READ_ORDER[model][0])


def test_pipeline_twice_with_late_hours(spark, store, as_of):
    """A second run loads what is new and equals a run over everything."""
    warehouse, folder = store
    day = "2024-01-30T{:02d}:00:00Z"
    land(folder, "2024-01-30-5", *[landed(n, at=day.format(5)) for n in range(6)])
    records = metadata(spark, {"repo_id": 7, "topics": ["llm"], "fetched_at": NOW})
    models = run_pipeline(warehouse, as_of, str(folder), records)
    assert len(models) == len(set(models)) == 20
    assert collected(read_model(warehouse, ACTIVITY), "activity_date", "stars") == [(date(2024, 1, 30), 6)]
    land(folder, "2024-01-31-6", landed(20, at=day.format(6)), landed(21, at="2024-01-31T06:00:00Z"))
    run_pipeline(warehouse, as_of, str(folder))
    stored = read_model(warehouse, ACTIVITY)
    assert collected(stored, "activity_date", "stars") == [(date(2024, 1, 30), 7), (date(2024, 1, 31), 1)]
    full = activity_of_events(warehouse.events())
    assert stored.select(*full.columns).exceptAll(full).isEmpty()
    assert collected(warehouse.ledger(), "hour_key", "row_count") == [("2024-01-30-5", 6), ("2024-01-31-6", 2)]
    assert collected(read_model(warehouse, "mart_ai_ecosystem"), "stars_this_week") == [8]
    assert spark.table("stg_watch_events").count() == 8
    ranked = read_model(warehouse, "mart_trending_repos", ordered=True)
    assert [row.activity_date for row in ranked.collect()] == [date(2024, 1, 31), date(2024, 1, 30)]


def test_bound_clock_is_a_literal(spark):
    events = binding.bound_events(spark, DATA)
    window = events.where(F.col("created_at") >= AsOf(NOW).time_ago(90))
    assert "current_timestamp" not in window._jdf.queryExecution().optimizedPlan().toString()
