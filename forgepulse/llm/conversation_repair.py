"""Conversation structure repair: the cheapest edits that give a legal order of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.sources.storage import Scratch

KEEP, DELETE, INSERT, REROLE = "K", "D", "I", "R"
INSERT_COST = REROLE_COST = TRUNCATED_COST = 3
DELETE_COST = 4
# Role orders `(s?(ua)+)?` as an automaton: at the start, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
LEGAL_ENDS = (START, ASSISTANT)
BY_INITIAL = {(START, "s"): SYSTEM, (USER, "a"): ASSISTANT} | {
    (state, "u"): USER for state in (START, SYSTEM, ASSISTANT)
}
LEGAL_PAIRS = {"su", "ua", "au"}
NAMES = {USER: "user", ASSISTANT: "assistant"}
# Rows of one conversation that a task holds at a time; longer ones go in pieces.
PIECE = 4096
# Modulus (a Mersenne prime) and base of the rolling hashes. Fixed values.
MODULUS, BASE = (1 << 61) - 1, 0x1F2E3D4C5B6A79


class Path:
    """A sequence of edits as its last letter and the path before, which other paths share.

    `up[k]` is the path 2^k letters shorter, `hash` a rolling hash of all letters.
    """

    __slots__ = ("depth", "letter", "hash", "up")

    def __init__(self, before: Path | None, letter: str):
        self.letter = letter
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * BASE + ord(letter)) % MODULUS
        up, k = [before], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = up

    def shortened(self, depth: int) -> Path:
        """The path's first `depth` letters."""
        path, excess = self, self.depth - depth
        while excess:
            k = excess.bit_length() - 1
            path, excess = path.up[k], excess - (1 << k)
        return path

    def text(self) -> str:
        letters, path = [], self
        while path.depth:
            letters.append(path.letter)
            path = path.up[0]
        return "".join(reversed(letters))


def first_difference(a: Path, b: Path) -> tuple[Path, Path] | None:
    """The shortest paths of equal length on the way to a and to b that end in different
    letters; None if one is the beginning of the other.

    The longest common prefix is searched from the longest ancestors down: unequal hashes
    are unequal paths. Equal hashes are verified letter by letter, down to the path both
    share, so a collision only costs time.
    """
    depth = min(a.depth, b.depth)
    a, b = a.shortened(depth), b.shortened(depth)
    found = None
    if a.hash != b.hash:
        for k in range(depth.bit_length(), -1, -1):
            if k < len(a.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        found = a, b
        a, b = a.up[0], b.up[0]
    while a is not b:
        if a.letter != b.letter:
            found = a, b
        a, b = a.up[0], b.up[0]
    return found


def follows(a: Path, more: str, b: Path, other: str) -> bool:
    """Whether path b and then `other` comes before path a and then `more`, in ASCII order."""
    difference = first_difference(a, b)
    if difference:
        return difference[1].letter < difference[0].letter
    if a.depth == b.depth:
        return other < more
    if a.depth < b.depth:
        return b.shortened(a.depth + 1).letter < more
    return other < a.shortened(b.depth + 1).letter


class Audit:
    """Cheapest edits for each state of the automaton; of equally cheap ones the first in
    ASCII order.

    Of two ways to a state that cost the same, neither is the beginning of the other: the
    longer one would have more insertions. So the first one stays first whatever follows.
    """

    def __init__(self, start: int = START):
        nothing = Path(None, "")
        self.best: list[tuple[int, Path] | None] = [None] * 4
        self.best[start] = (0, nothing)
        self._insert()

    def _insert(self) -> None:
        for state, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            offers = [(self.best[state], None)] if self.best[state] else []
            offers += [
                (self.best[source], INSERT) for source in sources
                if self.best[source] and not (
                    self.best[state] and self.best[source][0] + INSERT_COST > self.best[state][0]
                )
            ]
            self.best[state] = _least(
                [(cost + (INSERT_COST if letter else 0), path, letter) for (cost, path), letter in offers]
            )

    def take(self, initial: str, must_go: bool, truncated: bool) -> None:
        """One row's edits, then insertions after it."""
        offers: list[list] = [[], [], [], []]
        extra = TRUNCATED_COST if truncated else 0
        for state, best in enumerate(self.best):
            if best is None:
                continue
            cost, path = best
            offers[state].append((cost + DELETE_COST, path, DELETE))
            if must_go:
                continue
            kept = BY_INITIAL.get((state, initial))
            if kept is not None:
                offers[kept].append((cost + extra, path, KEEP))
            to = ASSISTANT if state == USER else USER
            offers[to].append((cost + extra + REROLE_COST, path, REROLE))
        self.best = [_least(offer) for offer in offers]
        self._insert()


def _least(offers: list[tuple[int, Path, str | None]]) -> tuple[int, Path] | None:
    """The cheapest of (cost, path, letter that follows it, or None), as (cost, whole path)."""
    if not offers:
        return None
    least = min(offer[0] for offer in offers)
    cost, path, letter = next(offer for offer in offers if offer[0] == least)
    chosen, ties = (path, letter), [offer[1:] for offer in offers if offer[0] == least]
    for other, more in ties[1:]:
        if follows(chosen[0], chosen[1] or "", other, more or ""):
            chosen = other, more
    path, letter = chosen
    return least, Path(path, letter) if letter else path


class Row:
    """What the audit needs of a row, and what the repaired conversation does."""

    __slots__ = ("turn", "role", "text", "blank", "duplicate", "truncated")

    def __init__(self, turn, role: str, text: str):
        self.turn, self.role, self.text = turn, role, text
        bare = text.rstrip(" \t\n\v\f\r")
        self.blank, self.duplicate = not bare, False
        self.truncated = bool(bare) and bare[-1] not in ".!?"

    @property
    def must_go(self) -> bool:
        return self.blank or self.duplicate


def repaired(rows: Iterable[Row], audit: str, state: int = START) -> Iterator[tuple[int | None, str, str, str]]:
    """(place of the row or None, edit, role, text) of all that stays or is put in; deleted
    rows give nothing. `state` is the automaton's where the audit begins."""
    rows, at = iter(rows), -1
    for letter in audit:
        row = None
        if letter != INSERT:
            row, at = next(rows), at + 1
        if letter == DELETE:
            continue
        if letter == KEEP:
            state = BY_INITIAL[state, row.role[:1]]
            yield at, letter, row.role, row.text
        else:
            state = ASSISTANT if state == USER else USER
            yield (at if row else None), letter, NAMES[state], (row.text if row else "")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


class Faults:
    """Counts over the rows of a conversation, or of a piece of one, in their order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, row: Row) -> None:
        self.blank += row.blank
        self.duplicate += not row.blank and row.duplicate
        self.truncated += row.truncated and not row.duplicate
        initial = row.role[:1]
        if self.last_role is None:
            self.first_role = initial
        else:
            self.illegal += self.last_role + initial not in LEGAL_PAIRS
        self.last_role = initial
        if row.turn is not None:
            if self.first_turn is None:
                self.first_turn = row.turn
            if row.turn != self.last_turn:
                self.turns += 1
            self.last_turn = row.turn

    def join(self, other: Faults) -> None:
        """The counts of these rows and the ones after them."""
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        if other.last_role is not None:
            if self.last_role is None:
                self.first_role = other.first_role
            else:
                self.illegal += self.last_role + other.first_role not in LEGAL_PAIRS
            self.last_role = other.last_role
        if other.first_turn is not None:
            self.turns += other.turns - (other.first_turn == self.last_turn)
            if self.first_turn is None:
                self.first_turn = other.first_turn
            self.last_turn = other.last_turn

    def counts(self) -> tuple[int, ...]:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def audited(rows: list[Row]) -> tuple[int, str]:
    """Cost and letters of a whole conversation's cheapest edits."""
    audit = Audit()
    for row in rows:
        audit.take(row.role[:1], row.must_go, row.truncated)
    return _cheapest(audit.best)


def _cheapest(best: list[tuple[int, Path] | None]) -> tuple[int, str]:
    cost, path = _least([(*best[state], None) for state in LEGAL_ENDS if best[state]])
    return cost, path.text()


def _digest_of(rows: list[Row], audit: str) -> str:
    lines = (f"{role}:{text}" for _, _, role, text in repaired(rows, audit))
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
# closed: a conversation whose rows a task held all; the others' rows are handed on.
_STREAMED = (
    f"conv_id bigint, closed boolean, {SUMMARY}, repaired_sha256 string, "
    "part int, at bigint, turn bigint, role string, text string, gone boolean"
)
_NAMES = [field.split()[0] for field in _STREAMED.split(", ")]
# A piece's cheapest edits from each state to each, and its counts.
_PIECE_SCHEMA = (
    "conv_id bigint, part int, piece bigint, counts array<bigint>, first_turn bigint, last_turn bigint, "
    "first_role string, last_role string, costs array<bigint>, audits array<string>"
)


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, schema.field(name).type) for name, column in zip(names, columns, strict=True)],
        names=names,
    )


def _arrow(schema: str) -> pa.Schema:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
        "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def _rows_of(batches: Iterable[pa.RecordBatch], slice_rows: int = 1024) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, slice_rows):
            part = batch.slice(at, slice_rows)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: str, size: int = 1024) -> Iterator[pa.RecordBatch]:
    arrow, held = _arrow(schema), []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, arrow.names, arrow)
            held = []
    if held:
        yield _batch(held, arrow.names, arrow)


def _streamed(piece: int, piece_chars: int):
    """Sorted rows of a range of conversations into results of those that lie inside it, and
    the rows of the first, the last and overlong ones, which other tasks may have rows of."""
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        nothing = (None,) * (len(COUNTS) + 3)
        key, held, chars, opened, at = object(), [], 0, True, 0

        def handed_on() -> Iterator[tuple]:
            for number, turn, role, text, gone in held:
                yield key, False, *nothing, part, number, turn, role, text, gone

        def closed() -> tuple:
            rows, seen, faults = [], set(), Faults()
            for _, turn, role, text, gone in held:
                if gone:
                    continue
                row = Row(turn, role, text)
                row.duplicate = (role, text) in seen
                seen.add((role, text))
                faults.add(row)
                rows.append(row)
            cost, audit = audited(rows)
            return key, True, *faults.counts(), cost, audit, _digest_of(rows, audit), *(None,) * 6

        for conv_id, turn, role, text, gone in _rows_of(batches):
            if conv_id != key:
                if at and opened:
                    yield from handed_on()
                elif at:
                    yield closed()
                opened = at == 0
                key, held, chars = conv_id, [], 0
            held.append((at, turn, role, text, gone))
            at += 1
            chars += len(text or "")
            if len(held) >= piece or chars >= piece_chars:
                opened = True
            if opened and (len(held) >= 256 or chars >= piece_chars):
                yield from handed_on()
                held, chars = [], 0
        yield from handed_on()

    return lambda batches: _batches(results(batches), _STREAMED)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, part, at) into a row per piece."""
    def results() -> Iterator[tuple]:
        held, faults, audits = None, Faults(), []

        def done() -> tuple:
            counts = [faults.turns, faults.blank, faults.duplicate, faults.truncated, faults.illegal]
            ways = [best for audit in audits for best in audit.best]
            return (
                *held, counts, faults.first_turn, faults.last_turn, faults.first_role, faults.last_role,
                [best and best[0] for best in ways], [best and best[1].text() for best in ways],
            )

        for conv_id, part, piece, turn, role, text, gone, duplicate in _rows_of(batches):
            if (conv_id, part, piece) != held:
                if held:
                    yield done()
                held, faults = (conv_id, part, piece), Faults()
                audits = [Audit(state) for state in STATES]
            if gone:
                continue
            row = Row(turn, role, text)
            row.duplicate = duplicate
            faults.add(row)
            for audit in audits:
                audit.take(role[:1], row.must_go, row.truncated)
        if held:
            yield done()

    return _batches(results(), _PIECE_SCHEMA, 16)


def _compared(a: tuple, b: tuple) -> int:
    """By cost, then by all letters of two chains of pieces (before, letters), equally long."""
    if a[0] != b[0]:
        return a[0] - b[0]
    a, b, tails = a[1], b[1], []
    while a is not b:
        tails.append((a[1], b[1]))
        a, b = a[0], b[0]
    one, other = ("".join(own) for own in zip(*reversed(tails), strict=True)) if tails else ("", "")
    return (one > other) - (one < other)


_JOINED = f"conv_id bigint, part int, piece bigint, letters string, state int, {SUMMARY}"


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (conv_id, part, piece) into a row for each conversation (part null)
    and one for each piece with its own letters and the state it begins in."""
    def results() -> Iterator[tuple]:
        key, best, faults, places = object(), [], Faults(), []

        def done() -> Iterator[tuple]:
            ends = [(*best[state], state) for state in LEGAL_ENDS if best[state]]
            cost, chain, _ = min(ends, key=cmp_to_key(_compared))
            letters = []
            while chain is not None:
                chain, own, state = chain
                letters.append((own, state))
            letters.reverse()
            audit = "".join(own for own, _ in letters)
            yield key, None, None, None, None, *faults.counts(), cost, audit
            for place, (own, state) in zip(places, letters, strict=True):
                yield key, *place, own, state, *(None,) * 7

        for conv_id, part, piece, counts, first_turn, last_turn, first_role, last_role, costs, audits in _rows_of(
            batches, 4
        ):
            if conv_id != key:
                if places:
                    yield from done()
                key, faults, places = conv_id, Faults(), []
                best = [(0, None), None, None, None]
            own = Faults()
            own.turns, own.blank, own.duplicate, own.truncated, own.illegal = counts
            own.first_turn, own.last_turn, own.first_role, own.last_role = first_turn, last_turn, first_role, last_role
            faults.join(own)
            places.append((part, piece))
            after: list = []
            for to in STATES:
                offers = [
                    (best[state][0] + costs[4 * state + to], (best[state][1], audits[4 * state + to], state))
                    for state in STATES if best[state] and costs[4 * state + to] is not None
                ]
                after.append(min(offers, key=cmp_to_key(_compared)) if offers else None)
            best = after
        if places:
            yield from done()

    return _batches(results(), _JOINED, 16)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, part, piece, at), each piece's letters before its rows, into
    (conv_id, repaired_sha256). A text passes by, and only the running digest stays."""
    def results() -> Iterator[tuple]:
        key, digest, letters, state, used, begun = object(), None, "", START, 0, False

        def put(role: str, text: str) -> None:
            nonlocal begun
            digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
            begun = True

        def insert() -> None:
            nonlocal used, state
            while used < len(letters) and letters[used] == INSERT:
                state = ASSISTANT if state == USER else USER
                put(NAMES[state], "")
                used += 1

        for conv_id, own, own_state, role, text, gone in _rows_of(batches):
            if conv_id != key:
                if digest:
                    insert()
                    yield key, digest.hexdigest()
                key, digest, letters, used, begun = conv_id, hashlib.sha256(), "", 0, False
            if own is not None:
                insert()
                letters, state, used = own, own_state, 0
            elif not gone:
                insert()
                letter = letters[used]
                used += 1
                if letter == KEEP:
                    state = BY_INITIAL[state, role[:1]]
                    put(role, text)
                elif letter == REROLE:
                    state = ASSISTANT if state == USER else USER
                    put(NAMES[state], text)
        if digest:
            insert()
            yield key, digest.hexdigest()

    return _batches(results(), "conv_id bigint, repaired_sha256 string")


def repair(
    conversations: DataFrame, scratch: Scratch, gone: str | None = None, piece: int = PIECE,
    piece_chars: int = 1 << 24,
) -> DataFrame:
    """A row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    `conversations` has conv_id, turn, role and text; other columns are not read. Rows whose
    boolean column `gone` is true only stand for their conversation. Rows are taken by turn,
    nulls first, then by role and XXH64 of the text; equal rows follow each other. A null
    role or text is one space; rows without a conv_id are one conversation, with a null
    conv_id. Conversations of gone rows only have zeros, an empty audit and the digest of
    nothing. An empty table gives no rows.

    The rows are range-partitioned by conversation and turn, so a conversation of any length
    is spread over as many tasks as it needs, and each conversation that lies inside a range
    is done at once. The others (a first and a last for each range, and overlong ones) go in
    pieces: each piece gives its cheapest edits from every state to every state, and pieces
    are joined by their states. Only a conversation's audit, a letter for a row, and its
    running digest, which has no parallel form, pass one task.
    """
    scratch = scratch.inner()
    spoken = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("gone"),
    )
    # Equal rows may be any number; the last key spreads them.
    order = ["conv_id", "turn", "role", "hash", "salt"]
    ranged = (
        spoken.withColumns({"hash": F.xxhash64("text"), "salt": F.rand(17)})
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "gone")
    )
    streamed = scratch.keep(ranged.mapInArrow(_streamed(piece, piece_chars), _STREAMED), name="streamed")
    columns = ["conv_id", *COUNTS, "cost", "audit", "repaired_sha256"]
    rows = streamed.where(~F.col("closed")).withColumns({
        "piece": F.floor(F.col("at") / piece).cast("bigint"),
        # Stands for the conversation in joins; no number is the empty text.
        "key": F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
        "digest": F.when(~F.col("gone"), F.sha2(F.concat(
            F.length("role").cast("string"), F.lit(":"), "role", "text"
        ), 256)),
    })
    firsts = rows.groupBy("key", "digest").agg(
        F.min(F.struct("part", "at")).alias("first"), F.count("*").alias("n")
    ).where("n > 1 and digest is not null")
    rows = scratch.keep(
        rows.join(firsts, ["key", "digest"], "left").withColumn(
            "seen", F.coalesce(F.struct("part", "at") != F.col("first"), F.lit(False))
        ).select("key", "conv_id", "part", "piece", "at", "turn", "role", "text", "gone", "seen"),
        name="open",
    )
    pieces = (
        rows.repartition("key", "part", "piece").sortWithinPartitions("key", "part", "at")
        .select("conv_id", "part", "piece", "turn", "role", "text", "gone", "seen")
        .mapInArrow(_pieces, _PIECE_SCHEMA)
    )
    in_order = ["conv_id", "part", "piece"]
    joined = scratch.keep(
        pieces.repartition("conv_id").sortWithinPartitions(*in_order).mapInArrow(_joined, _JOINED),
        name="joined",
    )
    spelled = joined.where(F.col("part").isNotNull()).select(
        *in_order, F.lit(-1).cast("bigint").alias("at"), "letters", "state",
        *[F.lit(None).cast("string").alias(name) for name in ("role", "text")], F.lit(False).alias("gone"),
    )
    told = rows.select(
        *in_order, "at", F.lit(None).cast("string").alias("letters"),
        F.lit(None).cast("int").alias("state"), "role", "text", "gone",
    )
    digests = (
        told.unionByName(spelled).repartition("conv_id").sortWithinPartitions(*in_order, "at")
        .select("conv_id", "letters", "state", "role", "text", "gone")
        .mapInArrow(_digests, "conv_id bigint, repaired_sha256 string")
    )
    whole = joined.where(F.col("part").isNull()).drop("part", "piece", "letters", "state")
    digests = digests.withColumnRenamed("conv_id", "own")
    opened = whole.join(digests, whole["conv_id"].eqNullSafe(digests["own"])).select(*columns)
    return streamed.where("closed").select(*columns).unionByName(opened)


EDITS = "conv_id bigint, place bigint, at bigint, edit string, new_role string"


def edits(audits: DataFrame) -> DataFrame:
    """The edits of every audit that put something out: place in the repaired conversation,
    `at`, the number of the row it takes (null for an inserted one), the edit's letter, and
    the role it gives (null where the row keeps its own). All from 0."""
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, audit in _rows_of(batches, 16):
            # An odd number of turns begins with a system turn.
            place, at, odd = 0, 0, (len(audit) - audit.count(DELETE)) % 2
            for letter in audit:
                if letter != DELETE:
                    role = None if letter == KEEP else NAMES[ASSISTANT if (place - odd) % 2 else USER]
                    yield conv_id, place, None if letter == INSERT else at, letter, role
                    place += 1
                at += letter != INSERT

    return audits.select("conv_id", "audit").mapInArrow(
        lambda batches: _batches(results(batches), EDITS), EDITS
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage of the contract: conv_id, turn, role, text, gone."""
    number, turn = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn"))
    role, text = (F.coalesce(name, F.lit(" ")) for name in ("role", "text"))
    kind = F.crc32(F.concat(number, F.lit(":"), turn)) % 20
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.explode(copies).alias("copy"),
    ).drop("copy")


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII text."""
    letters = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::bigint)"
    step = "case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: {step})"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {letters}), lambda c, b: {byte}), 4294967295)"


ORACLE = f"""
with recursive keyed as (
    select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as spelled from conversations
), kinds as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {crc32_sql("spelled")} % 20 as kind
    from keyed
), rows_after as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text
    from kinds, unnest(case when kind = 3 then [0, 1] else [0] end) as copies(copy)
    where kind <> 0
), numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as rn from rows_after
), marked as (
    select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
        row_number() over (partition by conv_id, role, text order by rn) > 1 as again,
        coalesce(regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?', ''), false)
            as cut,
        left(role, 1) as initial,
        lag(left(role, 1)) over (partition by conv_id order by rn) || left(role, 1) as pair
    from numbered
), counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
        count(*) filter (blank) as blank, count(*) filter (not blank and again) as duplicate,
        count(*) filter (not blank and not again and cut) as truncated,
        count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal, max(rn) as n
    from marked group by conv_id
), ways as (
    select conv_id, n, 0::bigint as i, {{'c': 0::bigint, 'a': ''}} as s0, null::struct(c bigint, a varchar) as s1,
        {{'c': 3::bigint, 'a': 'I'}} as s2, {{'c': 6::bigint, 'a': 'II'}} as s3
    from counted
    union all
    select conv_id, n, i, t0, t1, s2,
        list_min([t3, case when s2 is not null then {{'c': s2.c + 3, 'a': s2.a || 'I'}} end])
    from (
        select *, list_min([
            t2, case when t0 is not null then {{'c': t0.c + 3, 'a': t0.a || 'I'}} end,
            case when t1 is not null then {{'c': t1.c + 3, 'a': t1.a || 'I'}} end,
            case when t3 is not null then {{'c': t3.c + 3, 'a': t3.a || 'I'}} end
        ]) as s2
        from (
            select w.conv_id, w.n, w.i + 1 as i,
                {{'c': s0.c + 4, 'a': s0.a || 'D'}} as t0,
                list_min([
                    case when s1 is not null then {{'c': s1.c + 4, 'a': s1.a || 'D'}} end,
                    case when stays and initial = 's' then {{'c': s0.c + more, 'a': s0.a || 'K'}} end
                ]) as t1,
                list_min([
                    case when s2 is not null then {{'c': s2.c + 4, 'a': s2.a || 'D'}} end,
                    case when stays and initial = 'u' then {{'c': s0.c + more, 'a': s0.a || 'K'}} end,
                    case when stays and initial = 'u' and s1 is not null then {{'c': s1.c + more, 'a': s1.a || 'K'}} end,
                    case when stays and initial = 'u' and s3 is not null then {{'c': s3.c + more, 'a': s3.a || 'K'}} end,
                    case when stays then {{'c': s0.c + more + 3, 'a': s0.a || 'R'}} end,
                    case when stays and s1 is not null then {{'c': s1.c + more + 3, 'a': s1.a || 'R'}} end,
                    case when stays and s3 is not null then {{'c': s3.c + more + 3, 'a': s3.a || 'R'}} end
                ]) as t2,
                list_min([
                    case when s3 is not null then {{'c': s3.c + 4, 'a': s3.a || 'D'}} end,
                    case when stays and initial = 'a' and s2 is not null then {{'c': s2.c + more, 'a': s2.a || 'K'}} end,
                    case when stays and s2 is not null then {{'c': s2.c + more + 3, 'a': s2.a || 'R'}} end
                ]) as t3
            from ways w join (
                select conv_id, rn, initial, not blank and not again as stays, case when cut then 3 else 0 end as more
                from marked
            ) m on m.conv_id is not distinct from w.conv_id and m.rn = w.i + 1
        )
    )
), answers as (
    select conv_id, n, list_min([s0, s3]) as best from ways where i = n
), letters as (
    select conv_id, pos, substr(best.a, pos, 1) as letter,
        length(replace(best.a, 'D', '')) % 2 as odd,
        pos - length(replace(substr(best.a, 1, pos), 'I', '')) as put_in,
        length(replace(substr(best.a, 1, pos), 'D', '')) as place
    from answers, unnest(range(1, length(best.a) + 1)) as places(pos)
), turns_after as (
    select l.conv_id, l.pos,
        case when l.letter = 'K' then m.role when (l.place + l.odd) % 2 = 1 then 'user' else 'assistant' end || ':'
            || case when l.letter = 'I' then '' else m.text end as turn
    from letters l left join marked m
        on m.conv_id is not distinct from l.conv_id and m.rn = l.pos - l.put_in and l.letter <> 'I'
    where l.letter <> 'D'
), spelled_after as (
    select conv_id, string_agg(turn, chr(10) order by pos) as spelled from turns_after group by conv_id
)
select o.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank,
    coalesce(c.duplicate, 0)::bigint as duplicate, coalesce(c.truncated, 0)::bigint as truncated,
    coalesce(c.illegal, 0)::bigint as illegal, coalesce(a.best.c, 0)::bigint as cost,
    coalesce(a.best.a, '') as audit, sha256(coalesce(s.spelled, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join answers a on a.conv_id is not distinct from o.conv_id
left join spelled_after s on s.conv_id is not distinct from o.conv_id
"""
