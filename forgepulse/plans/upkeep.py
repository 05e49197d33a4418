"""Upkeep of the event table beside running loads."""

from __future__ import annotations

from collections import defaultdict
from datetime import date

from pyspark.sql import functions as F

from forgepulse.sources.versions import Conflict, Version
from forgepulse.sources.warehouse import EVENT_SEGMENTS, FILE_SEGMENTS, REJECTED_SEGMENTS, Warehouse
from forgepulse.schema import FILES, REJECTED

# Dates rewritten by one commit, so that a conflict costs little.
DATES_AT_ONCE = 64


def crowded_dates(warehouse: Warehouse, segments: int) -> dict[str, list[str]]:
    """The dates whose events lie in more than so many segments, with these."""
    lying: dict[str, list[str]] = defaultdict(list)
    for segment, entry in warehouse.version().get(EVENT_SEGMENTS).items():
        for day in entry["dates"]:
            lying[day].append(segment)
    return {day: sorted(found) for day, found in sorted(lying.items()) if len(found) > segments}


def compact_events(warehouse: Warehouse, segments: int = 8) -> list[date]:
    """Rewrites the dates whose events lie in more than `segments` segments into one each,
    and returns them.

    Hourly loads leave a segment, and a small file, for every date they meet. The rows stay
    the same, so a load that runs meanwhile neither waits nor fails: what it publishes is a
    segment of its own. Dates the daily tables have not taken in yet stay pending. A
    compaction that another one was first with leaves those dates as they are.
    """
    done: list[date] = []
    days = list(crowded_dates(warehouse, segments))
    for at in range(0, len(days), DATES_AT_ONCE):
        some = days[at:at + DATES_AT_ONCE]
        base = warehouse.version()
        before = {
            segment: [day for day in entry["dates"] if day in some]
            for segment, entry in base.get(EVENT_SEGMENTS).items()
        }
        before = {segment: own for segment, own in before.items() if own}
        rows = warehouse.events_of(base, [date.fromisoformat(day) for day in some])
        segment = warehouse.write_events(rows)

        def change(content: dict, _: Version) -> None:
            current, pending = content[EVENT_SEGMENTS], set()
            for old, own in before.items():
                entry = current.get(old)
                if entry is None or not set(own) <= set(entry["dates"]):
                    raise Conflict("these dates were compacted meanwhile")
                pending.update(day for day in entry["pending"] if day in own)
                entry["dates"] = [day for day in entry["dates"] if day not in own]
                entry["pending"] = [day for day in entry["pending"] if day not in own]
                if not entry["dates"]:
                    del current[old]
            current[segment] = {"dates": list(some), "pending": sorted(pending)}

        try:
            warehouse.publish(change)
            done += [date.fromisoformat(day) for day in some]
        except Conflict:
            warehouse.drop_segment(EVENT_SEGMENTS, segment)
    return done


def compact_files(warehouse: Warehouse) -> None:
    """One segment for the entries of all files and one for all unusable records, of each
    file's newest load only."""
    base = warehouse.pinned()
    files = base.files()
    rejected = base.read_segments(REJECTED_SEGMENTS, REJECTED, base.version().get(REJECTED_SEGMENTS)).join(
        files.select("file", F.col("batch")), ["file", "batch"], "left_semi"
    )
    written = {
        FILE_SEGMENTS: warehouse.write_segment(FILE_SEGMENTS, files.select(*FILES.names)),
        REJECTED_SEGMENTS: warehouse.write_segment(REJECTED_SEGMENTS, rejected.select(*REJECTED.names)),
    }

    def change(content: dict, now: Version) -> None:
        for table, segment in written.items():
            old = base.version().get(table)
            if not set(old) <= set(now.get(table)):
                raise Conflict("files were compacted meanwhile")
            newer = {name: entry for name, entry in now.get(table).items() if name not in old}
            content[table] = newer | {segment: {}}

    warehouse.publish(change)
