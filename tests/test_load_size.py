"""What a load does beside its rows: passes over the input, shuffles of whole rows, listings."""

from __future__ import annotations

import gzip
from pathlib import Path

import __spark_entry__ as registry
from conftest import collected
from test_jobs import land, landed

from forgepulse import binding
from forgepulse.operators.ingestion import ingest_hours
from forgepulse.sources.storage import A_TASK_EACH, LISTING_TASKS
from forgepulse.sources.warehouse import Warehouse

DATA = "/root/testdata/sf0.001"


def test_landing_is_one_pass_of_two_files_an_hour(spark, tmp_path):
    data = tmp_path / "data"
    data.symlink_to(DATA)
    folder = Path(registry._land(spark, str(data)).removeprefix("file:"))
    assert not any(path == str(data) for _, path in binding._stored), "no event table is stored for it"
    hours = [path for path in folder.iterdir() if path.name.startswith("hour_key=")]
    slots = {0: [], 1: []}
    count = 0
    for hour in hours:
        for path in hour.glob("part-*"):
            lines = gzip.open(path, "rt").read().splitlines()
            (broken,) = [line for line in lines if line.startswith("{broken ")]
            assert broken.split()[1] == hour.name.removeprefix("hour_key=")
            slot = int(broken.split()[2])
            slots[slot].append(int(path.name.split("-")[1]))
            ids = [int(line.split('"id":"')[1].split('"')[0]) for line in lines if line != broken]
            assert ids and {event_id % 2 for event_id in ids} == {slot}
            count += len(ids)
    assert count == binding.bound_events(spark, DATA).count()
    assert len(slots[0]) <= len(hours) and len(slots[1]) <= len(hours)
    assert max(slots[0]) < min(slots[1]), "even files are the older ones, so a stream parts the hours"


def test_whole_rows_are_shuffled_by_id_only_where_many_repeat(spark, tmp_path, as_of, monkeypatch):
    folder = tmp_path / "landing"
    folder.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    plans = []
    write_events = Warehouse.write_events

    def watched(self, events):
        plans.append(events._jdf.queryExecution().executedPlan().toString())
        return write_events(self, events)

    monkeypatch.setattr(Warehouse, "write_events", watched)
    land(folder, "2024-01-31-5", *[landed(n) for n in range(1, 5001)])
    land(folder, "2024-01-31-6", landed(7), landed(9001), landed(9001))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Less than the list of all ids, more than an empty one.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        ingest_hours(warehouse, str(folder), ["2024-01-31-5"], as_of)
        ingest_hours(warehouse, str(folder), ["2024-01-31-6"], as_of)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plans[0]
    assert collected(warehouse.events(), "event_id") == [*range(1, 5001), 9001]


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    number = spark.conf.get(LISTING_TASKS)
    try:
        spark.conf.unset(LISTING_TASKS)
        Warehouse(spark, str(tmp_path))
        assert int(spark.conf.get(LISTING_TASKS)) == 4 * spark.sparkContext.defaultParallelism != int(A_TASK_EACH)
        spark.conf.set(LISTING_TASKS, "7")
        Warehouse(spark, str(tmp_path))
        assert spark.conf.get(LISTING_TASKS) == "7"
    finally:
        spark.conf.set(LISTING_TASKS, number)
