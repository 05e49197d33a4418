"""Conversation prefix trie: adaptive radix trees over turn ids, one for each range of keys."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.conversation_repair import crc32_sql
from forgepulse.sources.storage import Scratch

# Bytes of a turn id: a big-endian number, the start of the SHA-256 of role and text.
WIDTH = 16
# Different conversations in one tree; a task builds one tree after the other.
KEYS = 4096
# Characters of ids that a task keeps for one node before it hands them on.
ENDS_CHARS = 1 << 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


class Small:
    """Up to `room` children: their key bytes in order, and the children beside them."""

    __slots__ = ("keys", "nodes", "room")

    def __init__(self, room: int, keys: list[int] = (), nodes: list[Node] = ()):
        self.room, self.keys, self.nodes = room, list(keys), list(nodes)

    def get(self, byte: int) -> Node | None:
        at = bisect_left(self.keys, byte)
        return self.nodes[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, node: Node) -> Small | Indexed:
        """The layout that now holds the child: this one, or the next larger if full."""
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.keys) < self.room:
            insort(self.keys, byte)
            self.nodes.insert(at, node)
            return self
        if self.room == 4:
            return Small(16, self.keys, self.nodes).put(byte, node)
        return Indexed(self.keys, self.nodes).put(byte, node)

    def children(self) -> Iterator[Node]:
        return iter(self.nodes)


class Indexed:
    """Up to 48 children: a place for each of 256 bytes, and the children in any order."""

    __slots__ = ("places", "nodes")

    def __init__(self, keys: list[int], nodes: list[Node]):
        self.places, self.nodes = bytearray(b"\xff") * 256, list(nodes)
        for place, byte in enumerate(keys):
            self.places[byte] = place

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return None if place == 255 else self.nodes[place]

    def put(self, byte: int, node: Node) -> Indexed | Full:
        place = self.places[byte]
        if place != 255:
            self.nodes[place] = node
        elif len(self.nodes) < 48:
            self.places[byte] = len(self.nodes)
            self.nodes.append(node)
        else:
            return Full(self).put(byte, node)
        return self

    def children(self) -> Iterator[Node]:
        return (self.nodes[place] for place in self.places if place != 255)


class Full:
    """A child for each of 256 bytes."""

    __slots__ = ("nodes",)

    def __init__(self, smaller: Indexed):
        self.nodes = [smaller.get(byte) for byte in range(256)]

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Full:
        self.nodes[byte] = node
        return self

    def children(self) -> Iterator[Node]:
        return (node for node in self.nodes if node is not None)


class Node:
    """The bytes on the way to this node from the one above, its children by their first
    byte, and what ends here."""

    __slots__ = ("path", "layout", "end")

    def __init__(self, path: bytes, end=None):
        self.path, self.layout, self.end = path, Small(4), end


class Tree:
    """An adaptive radix tree with path compression."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, end) -> None:
        node, at, above = self.root, 0, None
        while True:
            path = node.path
            same = _common(path, key, at)
            if same < len(path):
                # The way here divides: a new node stands where it does.
                fork = Node(path[:same])
                above.layout = above.layout.put(path[0], fork)
                node.path = path[same:]
                fork.layout = fork.layout.put(path[same], node)
                node = fork
            at += same
            if at == len(key):
                node.end = end
                return
            below = node.layout.get(key[at])
            if below is None:
                node.layout = node.layout.put(key[at], Node(key[at:], end))
                return
            above, node = node, below


def _common(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of `path` the key has from `at` on."""
    if key.startswith(path, at):
        return len(path)
    same = 0
    for a, b in zip(path, memoryview(key)[at:]):
        if a != b:
            break
        same += 1
    return same


class End:
    """The conversations with exactly these turns: their number, the smallest, the digest of
    their ids (None where other tasks may hold more of them), and bytes of each turn's text."""

    __slots__ = ("n", "least", "digest", "sizes")

    def __init__(self, n: int, least: int, digest: str | None, sizes: list[int]):
        self.n, self.least, self.digest, self.sizes = n, least, digest, sizes


class Turn:
    """A node of the trie: a place at a whole number of turns."""

    __slots__ = ("depth", "size", "end", "below", "n", "least", "leaves", "saved", "open", "id")

    def __init__(self, depth: int, size: int):
        self.depth, self.size, self.end, self.below, self.open = depth, size, None, [], False


def turns_of(tree: Tree) -> list[Turn]:
    """The trie's nodes, each before those below it: the byte depths of the tree at which a
    turn ends, within compressed paths too."""
    found: list[Turn] = []
    stack = [(tree.root, 0, None)]
    while stack:
        node, begin, above = stack.pop()
        until = begin + len(node.path)
        sizes = _any_end(node).sizes if node.path or above is None else ()
        first = 0 if above is None else begin // WIDTH + 1
        for depth in range(first, until // WIDTH + 1):
            turn = Turn(depth, sizes[depth - 1] if depth else 0)
            if above is not None:
                above.below.append(turn)
            found.append(turn)
            above = turn
        if node.end is not None:
            above.end = node.end
        below = list(node.layout.children())
        stack.extend((child, until, above) for child in reversed(below))
    return found


def _any_end(node: Node) -> End:
    while node.end is None:
        node = next(node.layout.children())
    return node.end


def _add_up(turns: list[Turn]) -> None:
    """Members, leaves and saved bytes of each node from those below it."""
    for turn in reversed(turns):
        turn.n = (turn.end.n if turn.end else 0) + sum(own.n for own in turn.below)
        turn.least = min([own.least for own in turn.below] + ([turn.end.least] if turn.end else []))
        shut = [own for own in turn.below if not own.open]
        turn.leaves, turn.saved = sum(own.leaves for own in shut), sum(own.saved for own in shut)
        if not turn.open:
            turn.leaves = turn.leaves or 1
            turn.saved += (turn.n - 1) * turn.size


_SCHEMA = (
    "kind string, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, size bigint, node string, parent string, "
    "part bigint, ends string"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64()}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in _SCHEMA.split(", "))])
CLOSED, OPEN, ENDS = "closed", "open", "ends"


def _batches(rows: Iterator[tuple], names: list[str], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, names)
            held = []
    if held:
        yield _batch(held, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, _ARROW.field(name).type) for name, column in zip(names, columns, strict=True)],
        names=names,
    )


def _range(keys: int, ends_chars: int):
    """Sorted (key, conv_id, sizes) of a range of keys into the trie's nodes.

    Nodes on the way to the first or the last key of a tree may be part of another tree too:
    they are `open`, and their rows hold what this tree adds to them. All others are closed.
    The ids that end at a first or last key are handed on as texts, in their order.
    """
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        groups: list[tuple[bytes, End]] = []
        key, end, held, chars, handed = None, None, [], 0, 0

        def ends_of(key: bytes, ids: list[str]) -> tuple:
            nonlocal number
            number += 1
            return ENDS, *(None,) * 9, _node_id(key), None, number, ",".join(ids)

        def finish(last: bool) -> Iterator[tuple]:
            """Closes the group of equal conversations that was read."""
            if last or not groups or handed:
                if held:
                    yield ends_of(key, held)
            else:
                end.digest = hashlib.sha256(",".join(held).encode()).hexdigest()
            groups.append((key, end))

        def tree() -> Iterator[tuple]:
            nonlocal number
            number += 2
            yield from _tree_rows(groups, number)

        rows = (
            row for batch in batches
            for row in zip(*(batch[name].to_pylist() for name in ("key", "conv_id", "sizes")), strict=True)
        )
        for own, conv_id, sizes in rows:
            if own != key:
                if key is not None:
                    # A tree ends with a group that was handed on, or when it is full.
                    full = len(groups) + 1 >= keys or handed
                    yield from finish(bool(full))
                    if full:
                        yield from tree()
                        groups = []
                key, end, held, chars, handed = own, End(0, conv_id, None, sizes), [], 0, 0
            spelled = str(conv_id)
            held.append(spelled)
            chars += len(spelled) + 1
            end.n += 1
            if chars >= ends_chars:
                yield ends_of(key, held)
                held, chars, handed = [], 0, 1
        if key is not None:
            yield from finish(True)
            yield from tree()

    return lambda batches: _batches(results(batches), _ARROW.names)


def _node_id(key: bytes) -> str:
    return hashlib.sha256(key).hexdigest()


def _tree_rows(groups: list[tuple[bytes, End]], number: int) -> Iterator[tuple]:
    tree = Tree()
    for key, end in groups:
        tree.insert(key, end)
    turns = turns_of(tree)
    # The first key's way, then the last key's, in the trie's order.
    for place, key in enumerate({groups[0][0]: 0, groups[-1][0]: 1}):
        at, digest = turns[0], hashlib.sha256()
        for depth in range(len(key) // WIDTH + 1):
            if depth:
                digest.update(key[(depth - 1) * WIDTH:depth * WIDTH])
                at = at.below[0 if place == 0 else -1]
            if not at.open:
                at.open, at.id = True, (digest.hexdigest(), number + place)
    _add_up(turns)
    if turns[0].open:
        yield _open_row(turns[0], None)
    for turn in turns:
        for own in turn.below:
            if own.open:
                yield _open_row(own, turn)
            else:
                yield (
                    CLOSED, own.least, own.depth, None if turn.open else turn.least, own.n, len(own.below),
                    own.leaves, own.saved, (own.end.digest if own.end else EMPTY_SHA256), own.size, None,
                    turn.id[0] if turn.open else None, None, None,
                )


def _open_row(turn: Turn, parent: Turn | None) -> tuple:
    shut = sum(not own.open for own in turn.below)
    return (
        OPEN, turn.least, turn.depth, None, turn.n, shut, turn.leaves, turn.saved,
        turn.end.digest if turn.end else None, turn.size,
        turn.id[0], parent and parent.id[0], turn.id[1], None,
    )


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of ids sorted by (node, part) into (node, ends_sha256); one text at a time."""
    def results() -> Iterator[tuple]:
        node, digest = None, None
        for batch in batches:
            for own, ends in zip(batch["node"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if own != node:
                    if node is not None:
                        yield node, digest.hexdigest()
                    node, digest = own, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
        if node is not None:
            yield node, digest.hexdigest()

    return _batches(results(), ["node", "ends_sha256"])


_TOTALS = ["node", "n_children", "n_leaves", "saved_tokens"]


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes in the reverse of the trie's order into the totals of their subtrees.

    Every node comes after those below it, so for each depth only the sums of the nodes
    whose parent is still to come are held.
    """
    def results() -> Iterator[tuple]:
        waiting: dict[int, tuple[int, int, int]] = {}
        names = ("node", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "size")
        for batch in batches:
            for node, depth, n, shut, leaves, saved, size in zip(
                *(batch[name].to_pylist() for name in names), strict=True
            ):
                below, more_leaves, more_saved = waiting.pop(depth + 1, (0, 0, 0))
                children = shut + below
                leaves = leaves + more_leaves if children else 1
                saved += more_saved + (n - 1) * size
                before = waiting.get(depth, (0, 0, 0))
                waiting[depth] = before[0] + 1, before[1] + leaves, before[2] + saved
                yield node, children, leaves, saved

    return _batches(results(), _TOTALS)


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (id, size), of every conversation in order.

    Turns are ordered by turn, nulls first, then by id; a null role or text is empty. An id
    is the first WIDTH bytes of a SHA-256 as hexadecimal digits, a size the text's UTF-8
    bytes. Rows without a conv_id belong to no conversation and are left out. A
    conversation's ids, not its texts, are one row.
    """
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), _base(F.col("conv_id").cast("bigint")).alias("base"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"), F.substring(digest, 1, 2 * WIDTH).alias("id"),
            F.octet_length(text).cast("bigint").alias("size"),
        ).alias("own"),
    )
    # By the group that `rebuilt` joins in, so that nothing is shuffled again for it.
    return (
        turns.repartition("base").groupBy("base", "conv_id")
        .agg(F.sort_array(F.collect_list("own")).alias("turns"))
        .select("conv_id", F.transform("turns", lambda x: F.struct(x["id"], x["size"])).alias("turns"), "base")
    )


def _base(conv_id: Column) -> Column:
    return conv_id - conv_id % 5


def rebuilt(conversations: DataFrame) -> DataFrame:
    """The sequences of the contract: the first h turns of conversation c - c % 5, then c's own
    after its first h, where h is the CRC-32 of c in decimal modulo 9."""
    own = sequences(conversations)
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    head = F.first(
        F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 8)), ignorenulls=True
    ).over(Window.partitionBy("base"))
    nothing = F.slice("turns", 1, 0)
    return own.withColumns({"head": head, "h": h}).select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h")),
            F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))),
        ).alias("turns"),
    )


def prefix_trie(
    turns: DataFrame, scratch: Scratch, keys: int = KEYS, ends_chars: int = ENDS_CHARS
) -> DataFrame:
    """The trie of sequences (conv_id, turns), a row for each node: conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The sequences are range-partitioned by their keys, the concatenated turn ids, so that
    the conversations of a prefix are neighbours, and by conv_id, which spreads any number
    of equal ones. A task builds one adaptive radix tree after the other, of `keys`
    different sequences each. What it shares with its neighbours are only the ways to a
    tree's first and last key: those nodes' parts are added up, and as the trie's order is
    the order of the keys, one pass from the last of them to the first sums their subtrees.
    Repeated rows of a conv_id are members each. Without sequences there is no node.
    """
    scratch = scratch.inner()
    keyed = turns.select(
        F.unhex(F.array_join(F.transform("turns", lambda x: x["id"]), "")).alias("key"), "conv_id",
        F.transform("turns", lambda x: x["size"]).alias("sizes"),
    )
    ranged = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    ranges = scratch.keep(ranged.mapInArrow(_range(keys, ends_chars), _SCHEMA), name="ranges")
    merged = scratch.keep(
        ranges.where(F.col("kind") == OPEN).groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("size").alias("size"),
            F.first("parent").alias("parent"), F.min("part").alias("part"), F.max("ends_sha256").alias("whole"),
            *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        name="open",
    )
    # A row for each turn of two keys of every tree.
    totals = (
        merged.select("node", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "size", "part")
        .repartition(1).sortWithinPartitions(F.desc("part"), F.desc("depth"))
        .mapInArrow(_totals, "node string, n_children bigint, n_leaves bigint, saved_tokens bigint")
    )
    ends = (
        ranges.where(F.col("kind") == ENDS).select("node", "part", "ends")
        .repartition("node").sortWithinPartitions("node", "part")
        .mapInArrow(_end_digests, "node string, ends_sha256 string")
    )
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv"))
    opened = (
        merged.select("node", "conv_id", "depth", "parent", "n_convs", "whole")
        .join(totals, "node").join(ends, "node", "left").join(parents, "parent", "left")
        .select(
            "conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens",
            F.coalesce("whole", "ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )
    # Only the few whose parent is open are joined; the others know it.
    closed = ranges.where(F.col("kind") == CLOSED)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    below = (
        closed.where(F.col("parent").isNotNull()).drop("parent_conv_id").join(parents, "parent")
        .withColumnRenamed("parent_conv", "parent_conv_id").select(*columns)
    )
    closed = closed.where(F.col("parent").isNull()).select(*columns).unionByName(below)
    return closed.unionByName(opened)


ORACLE = f"""
with turns as (
    select conv_id, turn, coalesce(text, '') as text,
        sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id
    from conversations where conv_id is not null
), own as (
    select conv_id, conv_id::varchar as spelled, list(id order by turn nulls first, id) as ids,
        list(strlen(text) order by turn nulls first, id) as sizes
    from turns group by conv_id
), hashed as (
    select *, {crc32_sql("spelled")} % 9 as h from own
), rebuilt as (
    select o.conv_id,
        list_concat(list_slice(coalesce(b.ids, []), 1, o.h), list_slice(o.ids, o.h + 1, len(o.ids))) as ids,
        list_concat(list_slice(coalesce(b.sizes, []), 1, o.h), list_slice(o.sizes, o.h + 1, len(o.sizes))) as sizes
    from hashed o left join own b on b.conv_id = o.conv_id - o.conv_id % 5
), members as (
    select conv_id, depth, array_to_string(list_slice(ids, 1, depth), '') as prefix,
        case when depth > 0 then sizes[depth] else 0 end as size, depth = len(ids) as ends
    from rebuilt, unnest(range(0, len(ids) + 1)) as depths(depth)
), nodes as (
    select depth, prefix, left(prefix, greatest(depth - 1, 0) * 64) as parent, min(conv_id) as conv_id, count(*) as n_convs,
        (count(*) - 1) * max(size) as saved,
        coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '') as ends
    from members group by depth, prefix
), children as (
    select depth - 1 as depth, parent as prefix, count(*) as n_children from nodes where depth > 0 group by 1, 2
), counted as (
    select n.*, coalesce(c.n_children, 0) as n_children
    from nodes n left join children c on c.depth = n.depth and c.prefix = n.prefix
), subtrees as (
    select up as depth, left(prefix, up * 64) as prefix, count(*) filter (n_children = 0) as n_leaves,
        sum(saved) as saved_tokens
    from counted, unnest(range(0, depth + 1)) as ups(up) group by 1, 2
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children,
    s.n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from counted n join subtrees s on s.depth = n.depth and s.prefix = n.prefix
left join nodes p on p.depth = n.depth - 1 and p.prefix = n.parent
"""
