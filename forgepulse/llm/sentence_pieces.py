"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


VOCABULARY = "piece_bpe_32k.model"
# The mark that stands for a space in a vocabulary. Fixed value.
SPACE = "▁"
# Words remembered per generation in a Python worker, and the longest that is remembered.
REMEMBERED = 600_000
LONGEST_REMEMBERED = 64
# Words of up to so many characters have their agenda in a list.
SHORT = 64
# Stands for a pair that is no piece.
NEVER = float("inf")
# Texts encoded at a time, so that a batch's texts need not all be Python objects at once.
ROWS_AT_ONCE = 256


class Disagreement(RuntimeError):
    """A word the library encodes otherwise."""


class Encoder:
    """Encodes words by an agenda of adjacent symbol pairs, and checks each with the library.

    The agenda holds every pair of neighbouring symbols that is a piece together, by score
    and then by place; the best is merged, and its new neighbours join the agenda. A symbol
    that is no piece in the end becomes its UTF-8 bytes.

    Two neighbouring characters can only be merged where some piece holds them side by side,
    so a text can be cut between any others, and what lies between two cuts is merged alone
    and remembered. No piece has a space behind another character, which is checked at the
    start, so each run of spaces begins a word; words are remembered too.
    Of two generations of words the older is forgotten when the younger is full.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.remembered = remembered
        self.ids: dict[str, int] = {}
        self.ranks: dict[str, float] = {}
        for number in range(library.get_piece_size()):
            if library.is_unused(number):
                raise ValueError(f"{path}: vocabularies with unused pieces are not supported")
            if library.is_byte(number) or library.is_control(number) or library.is_unknown(number):
                continue
            piece = library.id_to_piece(number)
            self.ids[piece] = number
            self.ranks[piece] = -library.get_score(number)
        self.bytes = [library.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
        if any(not library.is_byte(number) for number in self.bytes):
            raise ValueError(f"{path}: a vocabulary without pieces for all bytes is not supported")
        if library.normalize("a  ﬁ ") != f"{SPACE}a{SPACE}{SPACE}ﬁ{SPACE}":
            raise ValueError(f"{path}: only vocabularies that leave the text as it is are supported")
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError(f"{path}: pieces that go on after a space are not supported")
        self.side_by_side = {piece[at:at + 2] for piece in self.ids for at in range(len(piece) - 1)}
        self.lines_apart = not any("\n" in pair for pair in self.side_by_side)
        self.lead = len(library.encode("\n"))
        # Words, and what lies between two cuts of one, with their ids as 32-bit integers.
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.parts: dict[str, list[int]] = {}

    def ids_of(self, word: str) -> list[int]:
        """The ids of a word in the vocabulary's spelling, cut where nothing can be merged."""
        found, start, together, parts = [], 0, self.side_by_side, self.parts
        for at in range(1, len(word) + 1):
            if word[at - 1:at + 1] not in together:
                part = word[start:at]
                start = at
                ids = parts.get(part)
                if ids is None:
                    ids = self.merged(part)
                    if at <= LONGEST_REMEMBERED:
                        parts[part] = ids
                found += ids
        return found

    def merged(self, part: str) -> list[int]:
        """The ids of a part by the agenda."""
        found = []
        for symbol in self._heap_merged(part) if len(part) > SHORT else self._list_merged(part):
            own = self.ids.get(symbol)
            if own is None:
                found += [self.bytes[byte] for byte in symbol.encode()]
            else:
                found.append(own)
        return found

    def _list_merged(self, word: str) -> list[str]:
        """For short words the agenda is a list by place, whose first best entry is next."""
        rank, symbols = self.ranks.get, list(word)
        agenda = [rank(word[at:at + 2], NEVER) for at in range(len(word) - 1)]
        while agenda and (best := min(agenda)) != NEVER:
            at = agenda.index(best)
            piece = symbols[at] = symbols[at] + symbols[at + 1]
            del symbols[at + 1], agenda[at]
            if at < len(agenda):
                agenda[at] = rank(piece + symbols[at + 1], NEVER)
            if at:
                agenda[at - 1] = rank(symbols[at - 1] + piece, NEVER)
        return symbols

    def _heap_merged(self, word: str) -> list[str]:
        """For long ones it is a heap, so that a word of any length takes n log n steps."""
        symbols, n, ranks = list(word), len(word), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = enumerate(map(str.__add__, word, word[1:]))
        agenda = [(ranks[pair], at, pair) for at, pair in pairs if pair in ranks]
        heapify(agenda)
        while agenda:
            _, at, piece = heappop(agenda)
            right = after[at]
            # An entry is stale once one of its symbols was merged with another.
            if right >= n or not symbols[at] or symbols[at] + symbols[right] != piece:
                continue
            symbols[at], symbols[right] = piece, ""
            following = after[at] = after[right]
            left = before[at]
            if following < n:
                before[following] = at
                pair = piece + symbols[following]
                if pair in ranks:
                    heappush(agenda, (ranks[pair], at, pair))
            if left >= 0:
                pair = symbols[left] + piece
                if pair in ranks:
                    heappush(agenda, (ranks[pair], left, pair))
        return [symbol for symbol in symbols if symbol]

    def split(self, text: str) -> list[str]:
        """The text's words in the vocabulary's spelling: each but the rest of a line starts
        with the spaces before it."""
        if not text:
            return []
        spelled = SPACE + text.replace(" ", SPACE)
        words = []
        lines = spelled.split("\n") if self.lines_apart else [spelled]
        for number, line in enumerate(lines):
            if number:
                words.append("\n")
            start, *rest = line.split(SPACE)
            if start:
                words.append(start)
            spaces = SPACE
            for word in rest:
                if word:
                    words.append(spaces + word)
                    spaces = SPACE
                else:
                    spaces += SPACE
            if len(spaces) > 1:
                words.append(spaces[1:])
        return words

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of words not met before, agreed on by agenda and library."""
        found = [self.ids_of(word) for word in words]
        # The library puts a space before any text but the empty one. A word without one is
        # asked for behind a line feed, which it is never merged with.
        asked = [word[1:] if word[0] == SPACE else f"\n{word}" for word in words]
        for word, own, ids in zip(words, found, self.library.encode(asked), strict=True):
            if word[0] != SPACE:
                ids = ids[self.lead:]
            if ids != own and word != SPACE:
                raise Disagreement(f"{word!r}: agenda {own}, library {ids}")
        return [np.array(ids, dtype="<i4").tobytes() for ids in found]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        if len(self.words) > self.remembered:
            self.old, self.words = self.words, {}
        if len(self.parts) > self.remembered:
            self.parts = {}
        split = [self.split(text or "") for text in texts]
        words, old, once = self.words, self.old, {}
        new = list(set().union(*split) - words.keys())
        words.update((word, old[word]) for word in new if word in old)
        new = [word for word in new if word not in words]
        for word, ids in zip(new, self.learn(new), strict=True):
            (words if len(word) <= LONGEST_REMEMBERED else once)[word] = ids
        known = words.__getitem__
        if once:
            known = lambda word: once[word] if word in once else words[word]
        return [np.frombuffer(b"".join(map(known, own)), dtype="<i4") for own in split]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str, remembered: int) -> Encoder:
    """A worker's encoder, which outlives the task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, remembered)
    _encoders[path].remembered = remembered
    return _encoders[path]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(one) for one in values])].astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _with_columns(df: DataFrame, added: dict[str, str], of) -> DataFrame:
    """Adds Arrow columns that `of` makes of a slice of a batch; columns so named are replaced."""
    kept = [name for name in df.columns if name not in added]
    schema = ", ".join(
        [f"`{name}` {df.schema[name].dataType.simpleString()}" for name in kept]
        + [f"`{name}` {kind}" for name, kind in added.items()]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                arrays = [part[name] for name in kept] + of(part)
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added])

    return df.mapInArrow(rows, schema)


def encode(
    docs: DataFrame, path: str, text: str = "text", into: str = "ids", remembered: int = REMEMBERED
) -> DataFrame:
    """The rows of `docs` with the ids of their whole texts in `into`, an array of ints.

    Equal to the library's encode without begin or end ids. Null and empty texts have no
    ids. Rows, their order within a partition and all other columns stay; a column named
    as `into` is replaced. An empty table stays empty. Nothing is shuffled; every word is
    checked with the library when a worker meets it first, and one that the library would
    encode otherwise fails the job.
    """
    def of(part: pa.RecordBatch) -> list[pa.Array]:
        return [_lists(_encoder(path, remembered).encode(part[text].to_pylist()))]

    return _with_columns(docs, {into: "array<int>"}, of)


def decode(tokens: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The rows of `tokens` with the text of their ids in `into`, by the library's decode;
    null and empty ids are the empty text."""
    def of(part: pa.RecordBatch) -> list[pa.Array]:
        library = _encoder(path, REMEMBERED).library
        return [pa.array([library.decode(one or []) for one in part[ids].to_pylist()], pa.string())]

    return _with_columns(tokens, {into: "string"}, of)


def described(docs: DataFrame, path: str, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: the ids as decimal
    numbers joined by commas, and the text decoded from them. Encoded and decoded in one
    task, so that no ids travel."""
    columns = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}

    def of(part: pa.RecordBatch) -> list[pa.Array]:
        encoder = _encoder(path, remembered)
        sizes, spelled, texts = [], [], []
        for ids in encoder.encode(part["text"].to_pylist()):
            plain = ids.tolist()
            sizes.append(len(plain))
            spelled.append(hashlib.sha256(",".join(map(str, plain)).encode()).hexdigest())
            texts.append(hashlib.sha256(encoder.library.decode(plain).encode()).hexdigest())
        return [pa.array(sizes, pa.int64()), pa.array(spelled, pa.string()), pa.array(texts, pa.string())]

    return _with_columns(docs.select("doc_id", "text"), columns, of).drop("text")
