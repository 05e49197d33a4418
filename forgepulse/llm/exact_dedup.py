"""Exact dedup by a distributed radix partitioning from the first bytes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import SPACES, known_id, original_id
from forgepulse.sources.storage import Scratch

# Bytes of the first digit; each further one is so many times as wide, up to what a value
# may hold.
FIRST_DIGIT = 32
WIDENING = 4
WIDEST_DIGIT = 1 << 30


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACES}+", " ")


def equal_texts(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Each document with the row that stays of its equals: doc_id, keep_id, group_size,
    kept, text_sha256.

    A text's radix key is its length in bytes followed by its bytes. The documents are
    split by length and first digit, then by one digit after the other, only among the
    documents that still share all digits so far; a group of one is finished, and a group
    whose digits have ended is a group of equal texts. Equality is decided by the bytes
    alone. Digits widen, so a text of n bytes takes about log(n) rounds. Groups are counted by aggregates that combine before the shuffle, so
    thousands of copies reach a task as one row for each task before; adaptive execution
    splits the join that hands a large group its number. The shared digits have no bound,
    so they are merged with the texts at every size and never broadcast.

    Null texts count as empty, which are equal to each other. A null doc_id comes after
    all others. Of rows with the same text and doc_id one stays. The digest is output only.
    """
    scratch = scratch.inner()
    text = F.col("text").cast("binary")
    base = scratch.keep(
        docs.select(known_id(F.col("doc_id")).alias("did"), normalised(F.col("text")).alias("norm"))
        .select(
            F.monotonically_increasing_id().alias("uid"), "did",
            F.octet_length("norm").alias("length"),
            F.substring(F.col("norm").cast("binary"), 1, FIRST_DIGIT).alias("digit"),
            F.col("norm").alias("text"), F.sha2("norm", 256).alias("text_sha256"),
        ),
        name="base",
    )

    def shared(rows: DataFrame, *key: str) -> DataFrame:
        """The values of `key` that several rows have."""
        return rows.groupBy(*key).agg(
            F.min("uid").alias("next_group"), F.min("did").alias("keep_did"),
            F.count("*").alias("group_size"),
        ).where("group_size > 1")

    key = ["length", "digit"]
    columns = ["uid", "did", F.col("next_group").alias("grp"), "keep_did", "group_size"]
    groups = scratch.keep(shared(base, *key), name="groups")
    rest = F.substring(text, FIRST_DIGIT + 1, 2**31 - 1)
    rows = base.join(groups.hint("merge"), key).select(*columns, rest.alias("rest"))
    finished, width, step = [], FIRST_DIGIT, 0
    while True:
        rows = scratch.keep(rows, name=f"rows-{step}")
        ended = F.octet_length("rest") == 0
        finished.append(rows.where(ended).drop("rest"))
        going = rows.where(~ended)
        if going.isEmpty():
            break
        width = min(width * WIDENING, WIDEST_DIGIT)
        parts = going.select("uid", "did", "grp", "rest").withColumn(
            "digit", F.substring("rest", 1, width)
        )
        groups = scratch.keep(shared(parts, "grp", "digit"), name=f"groups-{step}")
        rest = F.substring("rest", width + 1, 2**31 - 1)
        rows = parts.join(groups.hint("merge"), ["grp", "digit"]).select(
            "uid", "did", F.col("next_group").alias("grp"), "keep_did", "group_size",
            rest.alias("rest"),
        )
        step += 1
    equal = finished[0]
    for more in finished[1:]:
        equal = equal.unionByName(more)
    staying = (
        equal.where(F.col("did") == F.col("keep_did")).groupBy("grp")
        .agg(F.min("uid").alias("uid")).select("uid", F.lit(True).alias("stays"))
    )
    return (
        base.select("uid", "did", "text_sha256")
        .join(equal.select("uid", "keep_did", "group_size").hint("merge"), "uid", "left")
        .join(staying, "uid", "left")
        .select(
            original_id(F.col("did")).alias("doc_id"),
            original_id(F.coalesce("keep_did", "did")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            (F.col("keep_did").isNull() | F.coalesce("stays", F.lit(False))).alias("kept"),
            "text_sha256",
        )
    )


ORACLE = r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
  from documents
)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, sha256(norm) as text_sha256
from texts window same as (partition by norm)
"""
