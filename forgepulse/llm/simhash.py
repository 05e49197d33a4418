"""SimHash near-dedup with bit-sliced comparison of candidate blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import NO_ID, known_id, original_id
from forgepulse.sources.storage import Scratch

BITS = 64
WORDS = 3
RADIUS = 3
SEED = 42
# Of these parts of a fingerprint, within the radius at least PARTS - RADIUS are equal.
PARTS = 6
# Fingerprints of one bucket that are compared in one task; larger buckets are tiled.
TILE = 4096
# Small buckets are compared together, about so many fingerprints at a time.
TOGETHER = 512
# Shingles hashed at a time, so that a very long text needs no more memory.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles, with repeats; 0 without words.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A bit is set if it
    is set in over half of the shingles' XXH64. A text of fewer words is one shingle.
    """
    total, counts = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in shingle_hashes(text, words, seed):
        total += len(hashes)
        counts += bit_counts(hashes)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def shingle_hashes(text: str | None, words: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of the text's word shingles in their order, in chunks; none without words."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(words, len(found)) - 1
    first, last = starts[: len(found) - span], ends[span:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), CHUNK):
        pairs = zip(first[at:at + CHUNK].tolist(), last[at:at + CHUNK].tolist(), strict=True)
        yield np.array([digest(joined[a:b], seed) for a, b in pairs], dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, the highest bit first."""
    rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """did, the text's XXH64 (Spark's) and the fingerprint fp, as signed longs, of every whole
    text."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(
                [fingerprint(text, words, seed) for text in batch["text"].to_pylist()], dtype=np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch["did"], batch["text_hash"], pa.array(values.view(np.int64))],
                names=["did", "text_hash", "fp"],
            )

    return docs.select(
        known_id(F.col("doc_id")).alias("did"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(of, "did bigint, text_hash bigint, fp bigint")


def near_rows(values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For n fingerprints an n x (n / 64) matrix of bits: which others lie within `radius`.

    `values` has a column for each 64 bits of a fingerprint, or is flat for 64 bits. The
    fingerprints are stored as vertical bit planes, 64 fingerprints to a word.
    Each query's bits are XORed with the planes one at a time, and the differences
    added to carry-save counters (planes of a binary number per fingerprint), so that
    one operation updates 64 distances. A counter past the radius stays past it; a word
    all of whose 64 counters are past it is abandoned.
    """
    n = len(values)
    values = values.reshape(n, -1)
    lanes = values.shape[1]
    words = -(-n // 64)
    padded = np.zeros((words * 64, lanes), dtype=np.uint64)
    padded[:n] = values
    order = np.arange(BITS, dtype=np.uint64)
    ones = np.uint64(2**64 - 1)
    # planes[b, w]: bit b of the fingerprints 64 w to 64 w + 63, the first in the lowest bit.
    planes = np.zeros((lanes * BITS, words), dtype=np.uint64)
    for lane in range(lanes):
        bits = ((padded[None, :, lane] >> order[:, None]) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bits.reshape(BITS, words, 64), axis=2, bitorder="little")
        planes[lane * BITS:(lane + 1) * BITS] = packed.view("<u8").reshape(BITS, words)
    real = np.full(words, ones)
    if n % 64:
        real[-1] = np.uint64((1 << (n % 64)) - 1)
    levels = radius.bit_length()
    near = np.zeros((n, words), dtype=np.uint64)
    step = max(1, (1 << 15) // words)
    for at in range(0, n, step):
        queries = values[at:at + step]
        rows = np.repeat(np.arange(len(queries)), words)
        columns = np.tile(np.arange(words), len(queries))
        past = ~real[columns]
        counter = [np.zeros(len(rows), dtype=np.uint64) for _ in range(levels)]
        for bit in range(lanes * BITS):
            lane = queries[:, bit // BITS]
            own = np.where((lane >> np.uint64(bit % BITS)) & np.uint64(1), ones, np.uint64(0))
            carry = planes[bit, columns] ^ own[rows]
            for level in range(levels):
                counter[level], carry = counter[level] ^ carry, counter[level] & carry
            past |= carry
            if bit % 8 == 7:
                if radius != (1 << levels) - 1:
                    past |= _above(counter, radius)
                alive = past != ones
                if not alive.any():
                    rows = rows[:0]
                    break
                if not alive.all():
                    rows, columns, past = rows[alive], columns[alive], past[alive]
                    counter = [plane[alive] for plane in counter]
        if len(rows):
            near[at + rows, columns] = ~past
    return near


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """The positions whose binary counter is greater than `radius`."""
    above = np.zeros_like(counter[0])
    equal = ~above
    for level in reversed(range(len(counter))):
        if (radius >> level) & 1:
            equal &= counter[level]
        else:
            above |= equal & counter[level]
            equal &= ~counter[level]
    return above


def forest(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (parent, child) by index that connect what `radius` connects: one less than
    the members of each component, however many pairs it has."""
    near = near_rows(values, radius)
    n = len(values)
    unseen = np.full(near.shape[1], np.uint64(2**64 - 1))
    parents, children = [], []

    def take(index: int) -> list[int]:
        found = near[index] & unseen
        hit = np.flatnonzero(found)
        if not len(hit):
            return []
        unseen[hit] &= ~found[hit]
        bits = np.unpackbits(found[hit].view(np.uint8), bitorder="little").reshape(len(hit), 64)
        row, bit = np.nonzero(bits)
        return (hit[row] * 64 + bit).tolist()

    for start in range(n):
        if not (int(unseen[start // 64]) >> (start % 64)) & 1:
            continue
        unseen[start // 64] &= np.uint64(~(1 << (start % 64)) & (2**64 - 1))
        queue = [start]
        while queue:
            at = queue.pop()
            new = take(at)
            parents += [at] * len(new)
            children += new
            queue += new
    return np.array(parents, dtype=np.int64), np.array(children, dtype=np.int64)


def _links_of_groups(
    radius: int | Callable[[int], int], together: int, lanes: Callable = lambda fp: fp.to_numpy()
):
    """Turns sorted groups (mask, part, i, j) of fingerprints into links between their nodes.

    `radius` may depend on the mask. `lanes` turns a column of fingerprints into an array
    of one or several longs each. Nodes with the same fingerprint are linked.
    """
    radius_of = radius if callable(radius) else lambda mask: radius

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys: np.ndarray, nodes: np.ndarray, values: np.ndarray):
            """Compares runs of whole groups of a radius; a link across groups is as true as
            any other."""
            firsts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            cuts, masks = [0], keys[:, 0]
            for at in firsts[1:].tolist() + [len(keys)]:
                if at - cuts[-1] >= together or at == len(keys) or (
                    masks[at] != masks[at - 1] and radius_of(masks[at]) != radius_of(masks[at - 1])
                ):
                    cuts.append(at)
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                different, index, inverse = np.unique(
                    values[a:b], axis=0, return_index=True, return_inverse=True
                )
                parents, children = forest(different, radius_of(masks[a]))
                own = nodes[a:b][index]
                out.append(np.stack([own[parents], own[children]]))
                first = own[inverse.reshape(-1)]
                equal = np.flatnonzero(first != nodes[a:b])
                out.append(np.stack([first[equal], nodes[a:b][equal]]))
            found = np.concatenate(out, axis=1) if out else np.zeros((2, 0), dtype=np.int64)
            low, high = found.min(axis=0), found.max(axis=0)
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["low", "high"])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[k].to_numpy() for k in ("mask", "part", "i", "j")], axis=1)
            part = (keys, batch["node"].to_numpy(), lanes(batch["fp"]).view(np.uint64))
            if rest is not None:
                part = tuple(np.concatenate(x) for x in zip(rest, part, strict=True))
            keys = part[0]
            # The last group may go on in the next batch.
            same = (keys == keys[-1]).all(axis=1)
            cut = len(keys) - (len(keys) if same.all() else int(np.argmin(same[::-1])))
            if cut:
                yield links(*[x[:cut] for x in part])
            rest = tuple(x[cut:] for x in part)
        if rest is not None and len(rest[0]):
            yield links(*rest)

    return of


def part_masks(parts: int = PARTS, radius: int = RADIUS) -> list[int]:
    """A mask for each choice of the parts that are equal."""
    edges = [BITS * i // parts for i in range(parts + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, parts - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def links(
    nodes: DataFrame, scratch: Scratch, radius: int = RADIUS, parts: int = PARTS,
    tile: int = TILE, together: int = TOGETHER,
) -> DataFrame:
    """Links (low, high) between the nodes (node, fp, all different fp) that connect all
    fingerprints within `radius` of each other.

    Two such fingerprints agree in parts - radius of their parts. Each fingerprint goes
    to a bucket for every choice of parts; buckets of one are dropped before the
    comparison. A bucket over `tile` is dealt over tiles, and each two tiles of it are
    compared in a group of their own, so no group exceeds twice a tile (by chance a bit
    more) and every pair of a bucket meets. A group hands out a forest, not its pairs.
    """
    masks = [_signed(mask) for mask in part_masks(parts, radius)]
    choices = F.array(*[
        F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(mask)).alias("part"))
        for k, mask in enumerate(masks)
    ])
    bucketed = nodes.withColumn("choice", F.explode(choices)).select(
        "node", "fp", "choice.mask", "choice.part"
    )
    shared = scratch.keep(
        bucketed.groupBy("mask", "part").agg(F.count("*").alias("n")).where("n > 1"), name="shared"
    )
    return _linked(bucketed.join(shared, ["mask", "part"]), tile, _links_of_groups(radius, together))


def _linked(bucketed: DataFrame, tile: int, of: Callable) -> DataFrame:
    """Links among the rows (mask, part, node, fp, n) of each bucket of n; null for one tile."""
    tiles = F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    grouped = (
        bucketed.withColumn("tiles", tiles).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "mask", "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            "node", "fp",
        )
    )
    key = ["mask", "part", "i", "j"]
    return (
        grouped.repartition(*key).sortWithinPartitions(*key)
        .mapInArrow(of, "low bigint, high bigint")
        .distinct()
    )


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """(node, root) for every node but the smallest of each component, which is the root.

    Large and small star steps in turn: every node's neighbours are linked to the smallest
    of them. The minimum is an aggregate that combines before the shuffle, so a hub is one
    row for each task; its links are joined back, which adaptive execution splits. Each
    turn is written to shared storage.
    """
    def checksum(df: DataFrame) -> tuple:
        return tuple(df.agg(
            F.count("*"), F.bit_xor(F.xxhash64("low", "high"))
        ).first())

    def hung(links: DataFrame, to: Column) -> DataFrame:
        """Links (centre, node): each node hung on the smallest node around its centre."""
        least = links.groupBy("centre").agg(F.least(F.min("node"), F.col("centre")).alias("least"))
        return links.join(least, "centre").where(to)

    current = scratch.keep(edges.where("low < high").distinct(), name=f"{name}-0")
    before, turn = checksum(current), 0
    while True:
        both = current.select(F.col("low").alias("centre"), F.col("high").alias("node")).unionByName(
            current.select(F.col("high").alias("centre"), F.col("low").alias("node"))
        )
        large = (
            hung(both, F.col("node") > F.col("centre"))
            .select(F.col("least").alias("low"), F.col("node").alias("high"))
            .where("low < high").distinct()
        )
        large = scratch.keep(large, name=f"{name}-large-{turn}")
        down = large.select(F.col("high").alias("centre"), F.col("low").alias("node"))
        least = down.groupBy("centre").agg(F.min("node").alias("least"))
        small = (
            down.join(least, "centre")
            .select(F.col("least").alias("low"), F.col("node").alias("high"))
            .unionByName(least.select(F.col("least").alias("low"), F.col("centre").alias("high")))
            .where("low < high").distinct()
        )
        turn += 1
        current = scratch.keep(small, name=f"{name}-{turn}")
        after = checksum(current)
        scratch.discard(f"{name}-{turn - 1}", f"{name}-large-{turn - 1}")
        if after == before:
            return current.select(F.col("high").alias("node"), F.col("low").alias("root"))
        before = after


def near_duplicates(
    docs: DataFrame, scratch: Scratch, words: int = WORDS, radius: int = RADIUS,
    seed: int = SEED, parts: int = PARTS,
) -> DataFrame:
    """doc_id, fingerprint, component_id and text_hash (XXH64) of every row of `docs`.

    Documents whose fingerprints differ in at most `radius` bits are linked;
    component_id is the smallest doc_id that links reach. Null and empty texts have
    fingerprint 0, linked like any other. A null doc_id comes after all others and its
    component_id is null only among its like. Repeated rows are one node with several
    rows in the result. Copies are one fingerprint, so they are never paired. Columns of
    `docs` but doc_id and text are not read, and an empty table gives an empty result.
    """
    scratch = scratch.inner()
    prints = scratch.keep(fingerprints(docs, words, seed), name="prints")
    nodes = scratch.keep(
        prints.groupBy("fp").agg(F.min("did").alias("node")), name="nodes"
    )
    # Rows without an id share a number; their fingerprints stand apart by another.
    unknown = F.when(F.col("node") == NO_ID, F.col("fp"))
    inner = nodes.select("fp", "node", unknown.alias("other"))
    numbered = inner.select(
        "fp", F.when(F.col("other").isNull(), F.col("node"))
        .otherwise(F.lit(NO_ID) - F.pmod(F.col("other"), F.lit(1 << 61))).alias("node"),
        F.col("node").alias("did"),
    )
    found = scratch.keep(links(numbered, scratch, radius, parts), name="links")
    roots = components(found, scratch)
    known = F.when(F.col("reached") > NO_ID - (1 << 61), F.lit(NO_ID)).otherwise(F.col("reached"))
    joined = (
        numbered.join(roots, "node", "left")
        .withColumn("reached", F.coalesce("root", "node"))
        .select("fp", known.alias("component"))
    )
    return prints.join(joined, "fp").select(
        original_id(F.col("did")).alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        original_id(F.col("component")).alias("component_id"), "text_hash",
    )
