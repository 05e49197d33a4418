"""Schemas of the stored tables and of the landed files.

Event times are UTC wall-clock times (`timestamp_ntz`), so no result depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

EVENT_COLUMNS = [
    "event_id", "event_type", "actor_id", "actor_login", "repo_id",
    "repo_name", "org_id", "org_login", "created_at", "source_file",
]

# `event_date` is the partition column of the stored table: the date of `created_at`.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("actor_id", T.LongType()),
    T.StructField("actor_login", T.StringType()),
    T.StructField("repo_id", T.LongType()),
    T.StructField("repo_name", T.StringType()),
    T.StructField("org_id", T.LongType()),
    T.StructField("org_login", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("event_date", T.DateType()),
])

# `fetched_at` orders the versions of a repository's record.
METADATA = T.StructType([
    T.StructField("repo_id", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("license", T.StringType()),
    T.StructField("stargazers_count", T.LongType()),
    T.StructField("forks_count", T.LongType()),
    T.StructField("owner_type", T.StringType()),
    T.StructField("is_fork", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
])

LEDGER = T.StructType([
    T.StructField("hour_key", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
])

QUARANTINE = T.StructType([
    T.StructField("record", T.StringType()),
    T.StructField("hour_key", T.StringType()),
])

# What is stored of each load (`batch`): its files, and their unusable records. The newest
# batch of a file counts.
FILES = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("hour_key", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("hour_files", T.LongType()),
    T.StructField("batch", T.LongType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])
REJECTED = T.StructType([
    T.StructField("record", T.StringType()),
    T.StructField("hour_key", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("batch", T.LongType()),
])

_PARTY = T.StructType([T.StructField("id", T.LongType()), T.StructField("login", T.StringType())])

LANDED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor", _PARTY),
    T.StructField("repo", T.StructType([
        T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    ])),
    T.StructField("org", _PARTY),
    T.StructField("created_at", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])
