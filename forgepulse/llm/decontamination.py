"""Benchmark decontamination: pigeonhole pieces, then bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgepulse.sources.storage import Scratch

# Errors allowed, as a part of an item's length in bytes.
ERROR_RATE = 0.08
# Benchmark text searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20
# Items of one place are compared by grams first from this number on.
TOGETHER = 8
# Bytes of a gram; the odd numbers spread grams over 16 bits. Fixed values.
GRAM, GRAM_FACTOR, GRAM_MIX = 3, 0x01000193, 0x9E3779B1

# Everything of ASCII but letters and digits separates words.
_SPACED = bytes(
    c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def normal(text: str | None) -> bytes:
    """Lower case, with single spaces for runs of ASCII white space and punctuation."""
    lowered = (text or "").lower().encode("utf-8", "surrogatepass")
    return b" ".join(lowered.translate(_SPACED).split())


def budget(item: bytes, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate)


def pieces(item: bytes, errors: int) -> list[tuple[int, bytes]]:
    """The item cut into errors + 1 pieces of almost equal length, with their offsets: of
    a match with so many errors at least one piece is untouched."""
    edges = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def bit_masks(item: bytes) -> dict[int, int]:
    """For each byte the positions of the item that hold it, as the bits of one number."""
    masks: dict[int, int] = {}
    for i, byte in enumerate(item):
        masks[byte] = masks.get(byte, 0) | 1 << i
    return masks


def best_distance(masks: dict[int, int], length: int, window: bytes, enough: int) -> int:
    """The least edit distance between the item and any part of `window` (Myers).

    The vertical differences of a column of the distance matrix are held as the bits of
    two numbers, and one step moves on by one byte of the window. Stops at a distance of
    `enough` or less, since a match is all that is asked for.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best = score
    for byte in window:
        equal = masks.get(byte, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
                if best <= enough:
                    return best
        # A match may start anywhere in the window: the first row stays zero.
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
    return best


class Matcher:
    """Finds the items of a block of the benchmark in texts.

    Items that share a piece are tried together: those whose windows begin at the same
    place, once for that place, and by bit-parallel distance only if enough of their grams
    stand in the window. An edit spoils at most GRAM of an item's grams, so an item that
    misses more than GRAM times its budget cannot be there.
    """

    def __init__(self, items: list[tuple[int | None, str]], rate: float = ERROR_RATE):
        import ahocorasick

        plain = [(number, text) for number, item in items if (text := normal(item))]
        self.budgets = np.array([budget(text, rate) for _, text in plain], dtype=np.int64)
        # An item too short for an error must at least stand as whole words.
        self.items = [
            (number, text if errors else b" " + text + b" ")
            for (number, text), errors in zip(plain, self.budgets.tolist(), strict=True)
        ]
        self.masks: dict[int, dict[int, int]] = {}
        self.grams: dict[int, np.ndarray] = {}
        self.lengths = np.array([len(text) for _, text in self.items], dtype=np.int64)
        places: dict[bytes, dict[int, list[int]]] = {}
        for k, (_, text) in enumerate(self.items):
            for offset, piece in pieces(text, int(self.budgets[k])):
                places.setdefault(piece, {}).setdefault(offset, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            groups = [(offset, np.array(own, dtype=np.int64)) for offset, own in at.items()]
            self.automaton.add_word(piece.decode("latin-1"), (len(piece), groups))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> set[int | None]:
        """The numbers of the items that occur in the text within their budgets; None for
        those without one."""
        if not self.items:
            return set()
        haystack = b" " + normal(text) + b" "
        found = np.zeros(len(self.items), dtype=bool)
        # The items tried at each place; pieces of one item often lead to the same place.
        tried: dict[int, set[int]] = {}
        for end, (length, groups) in self.automaton.iter(haystack.decode("latin-1")):
            for offset, group in groups:
                start = end + 1 - length - offset
                before = tried.setdefault(start, set())
                new = [k for k in group.tolist() if not found[k] and k not in before]
                if new:
                    before.update(new)
                    for k in self._possible(haystack, start, np.array(new, dtype=np.int64)):
                        found[k] = self._matches(haystack, start, k)
        return {self.items[k][0] for k in np.flatnonzero(found).tolist()}

    def _possible(self, haystack: bytes, start: int, group: np.ndarray) -> list[int]:
        """Those of the items at this place that have enough grams in common with it."""
        if len(group) < TOGETHER:
            return group.tolist()
        errors, lengths = self.budgets[group], self.lengths[group]
        window = haystack[max(0, start - int(errors.max())):start + int((lengths + errors).max())]
        here = np.zeros(1 << 16, dtype=bool)
        here[_grams(window)] = True
        own = [self._grams_of(k) for k in group.tolist()]
        sizes = np.array([len(one) for one in own])
        missing = np.add.reduceat(np.r_[~here[np.concatenate(own)], False], np.r_[0, np.cumsum(sizes)[:-1]])
        missing[sizes == 0] = 0
        return group[missing <= GRAM * errors].tolist()

    def _grams_of(self, k: int) -> np.ndarray:
        if k not in self.grams:
            self.grams[k] = _grams(self.items[k][1])
        return self.grams[k]

    def _matches(self, haystack: bytes, start: int, k: int) -> bool:
        item, errors = self.items[k][1], int(self.budgets[k])
        if start >= 0 and haystack.startswith(item, start):
            return True
        window = haystack[max(0, start - errors):start + len(item) + errors]
        if k not in self.masks:
            self.masks[k] = bit_masks(item)
        return best_distance(self.masks[k], len(item), window, errors) <= errors


def _grams(text: bytes) -> np.ndarray:
    """A 16-bit number for every GRAM bytes in turn; equal bytes have equal numbers."""
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    count = max(0, len(codes) - GRAM + 1)
    numbers = np.zeros(count, dtype=np.uint32)
    for at in range(GRAM):
        numbers = numbers * np.uint32(GRAM_FACTOR) + codes[at:at + count]
    return ((numbers * np.uint32(GRAM_MIX)) >> np.uint32(16)).astype(np.int64)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows of `docs` with `item_ids`, the sorted ids of the benchmark items in them,
    and `contaminated`, whether they hold any.

    An item occurs in a document if some part of the document's normal text is within
    `rate` of the item's length of it in edit distance. Each item is cut into one piece
    more than it may have errors; an automaton finds exact hits of all pieces in one pass
    over the document, and the window around each hit is verified with bit-parallel edit
    distance. The benchmark is a stated query set: it is read in blocks of about
    `block_bytes` of text, each sent to the executors and searched for in all documents; what
    was found is written between two blocks, so a worker holds one automaton at a time. The
    documents are never shuffled.

    Null and empty texts hold no item. Null or empty items, and those without a letter or
    digit, match nothing; items with a null id are searched for, but cannot be named. Items with
    the same text are all named. With an empty benchmark every list is empty. Columns named
    as the results are replaced.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    items = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), "text"
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    plain = docs.drop("item_ids", "contaminated")
    schema = T.StructType([
        *plain.schema.fields, T.StructField("item_ids", T.ArrayType(T.LongType())),
        T.StructField("contaminated", T.BooleanType()),
    ])
    result = plain.withColumns({
        "item_ids": F.array().cast("array<bigint>"), "contaminated": F.lit(False)
    })
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([tuple(row) for row in part.collect()])

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, rate)
            for batch in batches:
                found = [matcher.find(text) for text in batch["text"].to_pylist()]
                lists = [
                    sorted({*known, *(new - {None})})
                    for known, new in zip(batch["item_ids"].to_pylist(), found, strict=True)
                ]
                flags = [
                    known or bool(new)
                    for known, new in zip(batch["contaminated"].to_pylist(), found, strict=True)
                ]
                names = [name for name in batch.schema.names if name not in ("item_ids", "contaminated")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[name] for name in names), pa.array(lists, type=pa.list_(pa.int64())),
                        pa.array(flags, pa.bool_()),
                    ],
                    names=[*names, "item_ids", "contaminated"],
                )

        result = result.select(*plain.columns, "item_ids", "contaminated").mapInArrow(search, schema)
        if block + 1 < blocks:
            result = scratch.keep(result, name=f"block-{block}")
            if block:
                scratch.discard(f"block-{block - 1}")
    return result
