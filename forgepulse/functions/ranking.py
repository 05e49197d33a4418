"""Ranking without gathering the ranked rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def with_rank(rows: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds `RANK() OVER (PARTITION BY by ORDER BY value DESC)` as a bigint.

    A window over the rows would sort each group, or without `by` the whole input,
    in one task. A rank is one more than the number of rows with a greater value,
    so counting the rows per distinct value is enough: only those counts go through
    the window, and the ranks are joined back. The counts are combined before their
    shuffle, and a value held by most rows is split by the adaptive skew join.

    Distinct values stay few: k distinct positive counts add up to k(k+1)/2 at least,
    so n events have under sqrt(2n) of them (1.4 million at 10^12 events).

    `rows` is read twice; pass a stored table or a kept result.
    """
    ties, above = "_ties", Window.partitionBy(*by).orderBy(F.desc(value))
    counts = rows.groupBy(*by, value).agg(F.count("*").alias(ties))
    before = F.sum(ties).over(above.rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select(*by, value, (F.coalesce(before, F.lit(0)) + 1).cast("bigint").alias(name))
    return rows.join(ranks, [*by, value]).select(*rows.columns, name)
