"""Token ids in ORC files: run-length encoded, with row indexes and Bloom filters."""

from __future__ import annotations

import json
import os
import string
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import NO_ID, known_id, original_id

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
# Words remembered per generation in a Python worker.
REMEMBERED = 600_000
# Bytes of text whose words are looked up together.
BYTES_AT_ONCE = 1 << 20
_OTHER_SPACES = (
    r"\x09\x0b-\x0d\x1c-\x1f\x85\xa0\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}"
)
# Texts that are not cut at words: white space at an edge, next to other white space or of
# another kind, where pieces might join, and special tokens.
WHOLE = rf"^[ \n]|[ \n]$|[ \n][ \n]|[{_OTHER_SPACES}]|<\|"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "did",
    "orc.bloom.filter.fpp": "0.01",
}


def _byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes each byte as: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _common(letters: str) -> bool:
    return letters.isascii() or max(letters) < "\u0250"


class Units:
    """The ids of words that follow a space, or with a line feed before them those of the line
    feed and the word, found out by the tokenizer when first met.

    A word is remembered from its second meeting on, since most words of a corpus are met
    once; a byte for each hash tells of the first. Of two generations the older is forgotten
    when the younger is full.
    """

    letters = _byte_letters()

    def __init__(self, tokenizer, model, remembered: int):
        self.tokenizer, self.model, self.remembered = tokenizer, model, remembered
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.met = bytearray(1 << 22)
        self.line_feed = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, units: list[str]) -> list[bytes]:
        if len(self.young) > self.remembered:
            self.young, self.old, self.met = {}, self.young, bytearray(len(self.met))
        known, met = self.young.get, self._met
        return [known(unit) or met(unit) for unit in units]

    def _met(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            ids, at = self._encoded(unit), hash(unit) % len(self.met)
            if not self.met[at]:
                self.met[at] = 1
                return ids
        self.young[unit] = ids
        return ids

    def _encoded(self, unit: str) -> bytes:
        # Without digits, marks and rare letters the word is one pre-token, which goes to
        # the model at once. Marks at its end are another.
        if unit.isalpha() and _common(unit):
            return self._merged(" " + unit)
        if unit[:1] == " ":
            return self.whole(unit[1:])
        lead = unit[:1] if unit[:1] == "\n" else ""
        word = unit[len(lead):]
        if lead and word.isalpha() and _common(word):
            return self.line_feed + self._merged(word)
        stem = word.rstrip(string.punctuation)
        if stem != word and stem.isalpha():
            # No word holds a space, so marks have keys of their own.
            parts = lead + stem, " " + word[len(stem):]
            return b"".join(self.young.get(part) or self._met(part) for part in parts)
        return self.line_feed + self.whole(word) if lead else self.whole(" " + word)

    def _merged(self, word: str) -> bytes:
        if word.isascii():
            spelled = word.replace(" ", self.letters[32])
        else:
            spelled = word.encode().decode("latin-1").translate(self.letters)
        return _packed([token.id for token in self.model.tokenize(spelled)])


def _cuts_at_words(spec: dict) -> bool:
    """Whether the tokenizer's own pre-tokenizer splits as `Units` expects."""
    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    return (
        spec["normalizer"] is None and model["type"] == "BPE"
        and not any(model.get(key) for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space", True)
    )


def _without_cache(model: dict):
    """The model without its own cache of words: for words that are asked for once, the cache
    costs as much as the merging."""
    from tokenizers.models import BPE

    kept = {key: model[key] for key in ("unk_token", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(key)}
    return BPE(model["vocab"], [tuple(pair) for pair in model["merges"]], cache_capacity=0, **kept)


class Encoder:
    """Encodes texts word by word, remembering the ids of each word.

    The tokenizer never merges over the place before a single space between two other
    characters, nor on either side of a single line feed between two others. A text with
    no other white space is cut there, and each word is encoded by the tokenizer once and
    then looked up, once for all texts that are encoded together. Any other text, or one
    with a special token's mark, is encoded whole. So is every text for a tokenizer that
    normalises, or splits otherwise than byte-level vocabularies do.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        # A task has one core; must be set before the library is first used.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        spec = json.loads(tokenizer.to_str())
        self.cuts = _cuts_at_words(spec)
        self.units = Units(tokenizer, _without_cache(spec["model"]) if self.cuts else None, remembered)
        # A line feed is one id, whose place `_looked_up` uses.
        self.cuts = self.cuts and len(self.units.line_feed) == 4

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        sizes, ids = self.joined(pa.array(texts, pa.string()), 0)
        ends = np.cumsum(sizes)
        return [ids[end - size:end - 1].tobytes() for end, size in zip(ends, sizes, strict=True)]

    def joined(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and all ids one after the other, with `end_id` after
        those of each text."""
        texts = texts.cast(pa.large_string())
        whole = np.ones(len(texts), dtype=bool)
        if self.cuts:
            whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        sizes, ids = self._looked_up(texts.filter(pa.array(~whole)), end_id)
        if not whole.any():
            return sizes, ids
        end = _packed([end_id])
        coded = [self.units.whole(text) + end for text in texts.filter(pa.array(whole)).to_pylist()]
        cut, others = iter(np.split(ids, np.cumsum(sizes)[:-1])), iter(coded)
        parts = [np.frombuffer(next(others), dtype="<u4") if is_whole else next(cut) for is_whole in whole]
        return np.array([len(part) for part in parts], dtype=np.int64), np.concatenate(parts)

    def _looked_up(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4")
        # A line feed before each text marks that no space precedes its first word.
        line_feed, nothing = (pa.scalar(text, pa.large_string()) for text in ("\n", ""))
        marked = pc.binary_join_element_wise(line_feed, pc.replace_substring(texts, "\n", " \n"), nothing)
        split = pc.split_pattern(marked, " ")
        words = split.values.dictionary_encode()
        known = self.units.ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        offsets = np.zeros(len(known) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, known), np.int64, len(known)), out=offsets[1:])
        ids_of = pa.Array.from_buffers(
            pa.large_binary(), len(known), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(known))]
        )
        _, offsets, ids = ids_of.take(words.indices).buffers()
        starts = np.frombuffer(offsets, dtype=np.int64)[split.offsets.to_numpy()] // 4
        # The id of each text's added line feed goes, and makes room for the end of the text before.
        ids = np.append(np.frombuffer(ids, dtype="<u4", count=starts[-1])[1:], np.uint32(end_id))
        ids[starts[1:] - 1] = end_id
        return np.diff(starts), ids


_encoders: dict[str, Encoder] = {}


def _encoder(path: str, remembered: int) -> Encoder:
    """A worker's encoder, which outlives the task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].units.remembered = remembered
    return _encoders[path]


def _in_parts(texts: pa.Array, most: int) -> Iterator[slice]:
    """Neighbouring texts of about `most` bytes together, larger ones alone or at a part's end."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = (np.flatnonzero(np.diff(ends // most)) + 1).tolist()
    return (slice(a, b) for a, b in zip([0, *cuts], [*cuts, len(texts)], strict=True) if a < b)


def encode(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, bytes_at_once: int = BYTES_AT_ONCE,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """did, part, part_start, n_tokens, ids of each document, in the order of doc_id.

    The documents are range-partitioned by doc_id before they are encoded, so ids are
    made once and never shuffled; `part_start` counts the ids before a document's in its
    own partition.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(tokenizer_path, remembered), 0
        for batch in batches:
            for part in _in_parts(batch["text"], bytes_at_once):
                rows = batch.slice(part.start, part.stop - part.start)
                sizes, values = encoder.joined(rows["text"], end_id)
                offsets = np.r_[0, np.cumsum(sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["did"], rows["part"], pa.array(before + offsets[:-1]), pa.array(sizes),
                        pa.ListArray.from_arrays(
                            pa.array(offsets.astype(np.int32)), pa.array(values.view("<i4"))
                        ),
                    ],
                    names=["did", "part", "part_start", "n_tokens", "ids"],
                )
                before += int(offsets[-1])

    ordered = (
        docs.select(known_id(F.col("doc_id")).alias("did"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("did").sortWithinPartitions("did")
        .withColumn("part", F.spark_partition_id())
    )
    return ordered.mapInArrow(
        of, "did bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"
    )


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
    remembered: int = REMEMBERED,
) -> None:
    """Writes the ids of all documents as ORC, one file (or more) for each range of doc_id.

    Stripes of 64 MB can be read by separate tasks. Integers are run-length encoded by
    the format; its row index and the Bloom filter on the document id let a reader skip
    stripes and row groups. Null texts are empty documents with the end id only; rows
    without a doc_id come last; an empty table gives an empty folder. Repeated rows are
    written as often as they occur. Fewer words remembered take less memory and more time.
    """
    writer = encode(docs, tokenizer_path, end_id, remembered=remembered).write
    for name, value in ORC_OPTIONS.items():
        writer = writer.option(name, value)
    writer.orc(path)


SCHEMA = "did bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids of every stored document; `start` counts all ids before it.

    The offset of each part is a running sum over the parts, a row each.
    """
    stored = spark.read.schema(SCHEMA).orc(path)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")
    )
    # One row for each file's partition, two numbers wide.
    return stored.join(F.broadcast(offsets), "part").select(
        original_id(F.col("did")).alias("doc_id"),
        (F.col("offset") + F.col("part_start")).alias("start"), "ids",
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The ids of some documents; the filter reaches the stripes' statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("did").isin(doc_ids)).select(
        F.nullif("did", F.lit(NO_ID)).alias("doc_id"), "ids"
    )


def described(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit integers."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            ids = batch["ids"]
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            sums = [
                zlib.crc32(values[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], batch["start"],
                    pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, type=pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(of, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
