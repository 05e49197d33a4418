"""What several corpus operators need: tables, word counts, positions in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgepulse.sources.storage import Scratch

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Stands for a missing doc_id inside an operator: after all others, and equal to itself.
NO_ID = 2**63 - 1
# The most bytes of an Arrow batch that goes to a Python worker, and Spark's default.
BATCH_BYTES, A_LARGE_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
SENT_AT_ONCE = 2 << 20


def send_little_at_once(spark: SparkSession) -> None:
    """Lets rows go to Python workers about SENT_AT_ONCE bytes at a time, unless the session has
    its own limit. By number alone 10,000 whole texts are one batch, which the executor, the
    worker and what the worker makes of it hold at once, and whose freed buffers neither
    process gives back."""
    if spark.conf.get(BATCH_BYTES) == A_LARGE_BATCH:
        spark.conf.set(BATCH_BYTES, str(SENT_AT_ONCE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """The number of runs of anything but ASCII white space; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def known_id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit(NO_ID))


def original_id(doc_id: Column) -> Column:
    return F.nullif(doc_id, F.lit(NO_ID))


class Aside:
    """A table whose columns an operator does not need go by other names meanwhile, so that
    none meets the names the operator uses."""

    def __init__(self, df: DataFrame, needed: Sequence[str]):
        self.columns = df.columns
        self.names = {
            name: f"__own_{number}" for number, name in enumerate(df.columns) if name not in set(needed)
        }
        self.df = df.withColumnsRenamed(self.names)

    def back(self, df: DataFrame) -> DataFrame:
        """The table's own columns out of what was made of `df`."""
        return df.select(*[F.col(self.names.get(name, name)).alias(name) for name in self.columns])


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of the named columns in which a null equals a null."""
    condition = left[names[0]].eqNullSafe(right[names[0]])
    for name in names[1:]:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], scratch: Scratch, name: str,
    into: str = "position",
) -> DataFrame:
    """Adds each row's place (from 0) in `order` among the rows with equal `keys`.

    The rows are range-partitioned by keys and order, so one key's rows are spread over
    as many tasks as they need; a row's place is its place in its own partition plus the
    rows of its key in earlier partitions. Only that list, a row per key and partition,
    passes through a window. Rows equal in keys and order get places in any order.
    """
    columns = [column for column in df.columns if column != into]
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        # The partition in the upper 31 bits, the row's number in it below.
        .withColumn("__row", F.monotonically_increasing_id())
    )
    rows = scratch.keep(ranged, name=f"{name}-rows").withColumn("__part", F.shiftright("__row", 33))
    so_far = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        rows.groupBy(*keys, "__part")
        .agg(F.min("__row").alias("__first"), F.count("*").alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(so_far), F.lit(0)))
        .drop("__rows")
    )
    # Written, so that the planner knows its size before it chooses a join.
    heads = scratch.keep(heads, name=f"{name}-heads")
    return (
        rows.join(heads, same(rows, heads, [*keys, "__part"]))
        .select(
            *[rows[column] for column in columns],
            (F.col("__row") - F.col("__first") + F.col("__before")).alias(into),
        )
    )
