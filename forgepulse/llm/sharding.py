"""Sharding by balanced label propagation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import known_id, original_id, positions
from forgepulse.sources.storage import Scratch

SHARDS = 16
ROUNDS = 12
SEED = 42
# Requests are admitted in this many random portions per pair of shards.
PORTIONS = 256
# A request for more than this part of a shard is admitted piece by piece.
PIECES = 64


def _hashed(count: int, *values) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), *values), F.lit(count)).cast("int")


def described(docs: DataFrame) -> DataFrame:
    """What sharding reads of each document; the text itself goes no further."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        known_id(F.col("doc_id")).alias("did"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_group"),
    )


def _literal_map(values: dict[int, int], key: Column, missing: int) -> Column:
    if not values:
        return F.lit(missing)
    pairs = [F.lit(x) for pair in sorted(values.items()) for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(missing))


def _admissible(asked: dict[tuple[int, int], int], free: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many rows may move between each two shards: exchanges, then what fits in free room."""
    one_way = {
        (a, b): rows - min(rows, asked.get((b, a), 0)) for (a, b), rows in asked.items()
    }
    into: dict[int, int] = {}
    for (_, b), rows in one_way.items():
        into[b] = into.get(b, 0) + rows
    admitted = {}
    for (a, b), rows in sorted(asked.items()):
        # In proportion to what is still asked and free, so that no room is lost by rounding.
        asks, room = one_way[a, b], max(0, free.get(b, 0))
        fits = min(asks, -(-room * asks // max(1, into[b])))
        free, into[b] = free | {b: room - fits}, into[b] - asks
        admitted[a, b] = rows - asks + fits
    return admitted


def propagate(
    tally: DataFrame, capacity: dict[int, int], scratch: Scratch, rounds: int = ROUNDS
) -> DataFrame:
    """Moves copies towards the shard that holds most of their group, round by round.

    `tally` has the rows of each linked group in each shard (text_group, shard, n). The
    documents of a group are alike, so their number in each shard is all the state there
    is: a group has a row per shard, however many documents it has. In each round the
    rows of a group ask to join its fullest shard that has room left. Between two
    shards as many rows move one way as the other, and the rest into free room; which
    requests are admitted is decided by random portions, whose sizes are added up per
    pair of shards. The driver sees those sums only: shards squared, not groups.
    """
    shards = len(capacity)
    piece = max(1, min(capacity.values()) // PIECES)
    names = ["tally"]
    for turn in range(rounds):
        loads = {row.shard: row.n for row in tally.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        free = {b: capacity[b] - loads.get(b, 0) for b in capacity}
        has_room = F.col("shard").isin([b for b in free if free[b] > 0])
        weight = F.struct("n", F.xxhash64("text_group", "shard"), "shard")
        best = F.max(F.when(has_room, weight)).over(Window.partitionBy("text_group"))
        rank = F.struct("n", F.xxhash64("text_group", "shard").alias("tie"), "shard")
        asking = (
            tally.withColumn("best", best.cast("struct<n:bigint,tie:bigint,shard:int>"))
            .where(F.col("best").isNotNull() & (F.col("best.shard") != F.col("shard")))
            .where(rank < F.col("best"))
            .select("text_group", "shard", F.col("best.shard").alias("goal"), "n")
            .withColumn("piece", F.explode(F.sequence(
                F.lit(0), F.floor((F.col("n") - 1) / piece).cast("int")
            )))
            .withColumn("n", F.least(F.lit(piece), F.col("n") - F.col("piece") * piece).cast("bigint"))
            .withColumn("portion", _hashed(PORTIONS, "text_group", "shard", "piece", F.lit(turn)))
        )
        asking = scratch.keep(asking, name=f"asking-{turn}")
        sums = asking.groupBy("shard", "goal", "portion").agg(F.sum("n").alias("n"))
        sums = scratch.keep(sums, name=f"sums-{turn}")
        asked = {
            (row.shard, row.goal): row.n
            for row in sums.groupBy("shard", "goal").agg(F.sum("n").alias("n")).collect()
        }
        admitted = _admissible(asked, free)
        pair = F.col("shard") * shards + F.col("goal")
        so_far = F.sum("n").over(
            Window.partitionBy("shard", "goal").orderBy("portion")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        limits = {
            row.pair: row.limit for row in sums.withColumn("so_far", so_far)
            .where(F.col("so_far") <= _literal_map(
                {a * shards + b: rows for (a, b), rows in admitted.items()}, pair, 0
            ))
            .groupBy(pair.alias("pair")).agg(F.max("portion").alias("limit")).collect()
        }
        if not limits:
            break
        moving = asking.where(F.col("portion") <= _literal_map(limits, pair, -1))
        changes = moving.select("text_group", F.col("goal").alias("shard"), "n").unionByName(
            moving.select("text_group", "shard", (-F.col("n")).alias("n"))
        )
        tally = scratch.keep(
            tally.unionByName(changes).groupBy("text_group", "shard")
            .agg(F.sum("n").alias("n")).where("n > 0"),
            name=f"tally-{turn}",
        )
        names.append(f"tally-{turn}")
        scratch.discard(names[-2], f"asking-{turn}", f"sums-{turn}")
    return tally


def shard(
    docs: DataFrame, scratch: Scratch, shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """Every document's shard and its gapless slot there; counts differ by one at most.

    Documents with the same text are linked. They start in random shards, label
    propagation gathers them under the shards' capacities, and documents without a link
    fill what is left: within a shard they are the first to go when it has too many.
    Only documents over a shard's capacity move again, in order, into the gaps. A group
    larger than a shard is spread over as few shards as have room.

    A null text counts as an empty one (size 1) and is linked to empty ones. Rows with the same
    or no doc_id are separate rows. An empty table gives an empty result. Returns
    doc_id, size, text_crc32, shard, slot.
    """
    scratch = scratch.inner()
    base = scratch.keep(described(docs).withColumn("start", _hashed(shards, "did")), name="base")
    total = base.count()
    capacity = {b: total // shards + (b < total % shards) for b in range(shards)}
    tally = base.groupBy("text_group", F.col("start").alias("shard")).agg(F.count("*").alias("n"))
    of_group = F.sum("n").over(Window.partitionBy("text_group"))
    tally = tally.withColumn("group_size", of_group).where("group_size > 1").drop("group_size")
    tally = propagate(scratch.keep(tally, name="tally"), capacity, scratch, rounds)

    # Each group's shards as intervals of [0, group size).
    ends = F.sum("n").over(
        Window.partitionBy("text_group").orderBy("shard")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    intervals = (
        tally.withColumn("end", ends).groupBy("text_group")
        .agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("intervals"))
    )
    linked = F.col("intervals").isNotNull()
    point = F.floor(
        F.pmod(F.xxhash64("did", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        * F.element_at("intervals", -1)["end"]
    )
    goal = F.get(F.filter("intervals", lambda part: part["end"] > point), F.lit(0))["shard"]
    assigned = base.join(intervals, "text_group", "left").select(
        "did", "size", "text_crc32", "text_group", (~linked).alias("single"),
        F.when(linked, goal).otherwise(F.col("start")).alias("shard"),
    )
    ranked = positions(
        assigned, ["shard"], ["single", "text_group", "did"], scratch, "ranked", into="slot"
    )
    loads = {row.shard: row.n for row in ranked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    room = _literal_map(capacity, F.col("shard"), 0)
    staying = ranked.where(F.col("slot") < room)
    moving = positions(
        ranked.where(F.col("slot") >= room), [], ["shard", "slot"], scratch, "moving", into="turn"
    )
    held = {b: min(capacity[b], loads.get(b, 0)) for b in capacity}
    gaps, first = [], 0
    for b in capacity:
        gap = capacity[b] - held[b]
        if gap:
            gaps.append((first, first + gap, b, held[b]))
            first += gap
    turn = F.col("turn")

    def chosen(value) -> Column:
        return reduce(
            lambda rest, gap: F.when(turn < gap[1], value(gap)).otherwise(rest),
            reversed(gaps), F.lit(None).cast("bigint"),
        )

    filled = moving.withColumns({
        "shard": chosen(lambda gap: F.lit(gap[2])).cast("int"),
        "slot": chosen(lambda gap: turn - gap[0] + gap[3]),
    })
    columns = [
        original_id(F.col("did")).alias("doc_id"), "size", "text_crc32",
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"),
    ]
    return staying.select(*columns).unionByName(filled.select(*columns))
