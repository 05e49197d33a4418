"""Not-null checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# The columns of the event table that must not be null.
REQUIRED = ["event_id", "event_type", "repo_name"]


def dq_not_null(df: DataFrame, table: str, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """One row per column with its number of nulls, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", "failures"
    )


def observe_nulls(
    df: DataFrame, observation: Observation, columns: Sequence[str] = REQUIRED
) -> DataFrame:
    """The frame, with the same counts taken by `observation` while it is written.

    To be the last step before the write: where adaptive execution finds an input
    empty, it drops the steps below, and what they would have observed.
    """
    return df.observe(observation, *[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
