"""Every corpus query over the smallest tables, against SQL or a brute-force version."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from forgepulse.llm import queries as corpus

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("select doc_id, text from documents").fetchall())


@pytest.fixture(scope="module")
def results(spark):
    found = {}

    def of(name):
        if name not in found:
            found[name] = [row.asDict() for row in registry.queries()[name](spark, DATA).collect()]
        return found[name]

    return of


def test_all_are_registered():
    names = list(registry.queries())
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names
    assert set(corpus.ORACLE) <= set(corpus.QUERIES)


@pytest.mark.parametrize("name", list(corpus.ORACLE))
def test_query_equals_its_sql(results, duck, name):
    result = duck.execute(registry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    wanted = [dict(zip(names, row, strict=True)) for row in result.fetchall()]
    assert set(names) == set(results(name)[0])
    key = lambda row: [repr(row[name]) for name in sorted(names)]
    assert sorted(map(key, results(name))) == sorted(map(key, wanted))


def test_mix_meets_its_targets(results, texts):
    by_source = defaultdict(list)
    for row in results("op1_mixing"):
        assert row["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[row["doc_id"]]))
        assert row["taken"] <= 2 * row["size"]
        by_source[row["source"]].append(row)
    total = sum(row["size"] for row in results("op1_mixing"))
    assert sum(rows[0]["target"] for rows in by_source.values()) == pytest.approx(1.5 * total)
    for rows in by_source.values():
        taken, largest = sum(row["taken"] for row in rows), max(row["size"] for row in rows)
        assert abs(taken - rows[0]["target"]) <= 2 * largest


def test_shards_are_even_and_gapless(results, texts):
    rows = results("op3_sharding")
    assert sorted(row["doc_id"] for row in rows) == sorted(texts)
    shards = defaultdict(list)
    for row in rows:
        text = texts[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        shards[row["shard"]].append(row["slot"])
    assert set(shards) == set(range(16))
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    for slots in shards.values():
        assert sorted(slots) == list(range(len(slots)))


def test_copies_share_a_shard(results, texts):
    groups = defaultdict(list)
    for row in results("op3_sharding"):
        groups[texts[row["doc_id"]]].append(row["shard"])
    pairs = [group for group in groups.values() if len(group) > 1]
    assert pairs and all(len(set(group)) == 1 for group in pairs)


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for shingle in shingles:
        digest = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            counts[bit] += digest >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def components_of(prints, radius=3):
    """Brute force: all pairs, then the smallest id of each component."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(results, texts):
    prints = {i: simhash_of(text) for i, text in texts.items()}
    rows = results("op4_simhash")
    assert {row["doc_id"]: int(row["fingerprint"], 16) for row in rows} == prints
    assert {row["doc_id"]: row["component_id"] for row in rows} == components_of(prints)
    assert all(re.fullmatch("[0-9a-f]{16}", row["fingerprint"]) for row in rows)


def plain(text):
    return " ".join(re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else " ", text.lower()).split(" ")).split()


def test_contaminated_documents_hold_the_passage(results, texts, duck):
    items = dict(duck.execute("select item_id, text from benchmark").fetchall())
    norm = {i: " ".join(plain(text)) for i, text in texts.items()}
    for row in results("op5_decontamination"):
        exact = {i for i, text in items.items() if " ".join(plain(text)) in norm[row["doc_id"]]}
        assert exact <= set(row["item_ids"]) and row["contaminated"] == bool(row["item_ids"])
    assert any(row["contaminated"] for row in results("op5_decontamination"))


def test_tokens_equal_the_tokenizer(results, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    rows = {row["doc_id"]: row for row in results("op6_token_output")}
    for doc_id in sorted(texts):
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        row = rows[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_pieces_equal_the_library(results, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for row in results("op12_sentence_pieces"):
        ids = library.encode(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        doubled = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
        return 16 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def expected_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text) if valid(kind, m[0])
    ]


def test_base_spans_equal_the_patterns(results, texts):
    for row in results("op7_pii"):
        spans = expected_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in PATTERNS] == [
            sum(span.startswith(kind) for span in spans) for kind in PATTERNS
        ]
        assert set(spans) <= set(row["spans"].split(",")) | {""}


def test_language_on_held_out_documents(results, duck):
    truth = dict(duck.execute("select doc_id, lang from documents").fetchall())
    rows = results("op8_language_id")
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row["held_out"]]
    right = sum(row["lang_pred"] == truth[row["doc_id"]] for row in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_pipeline_equals_its_stages_by_brute_force(spark, results, texts, duck):
    """Language, groups and passages by what the other tests hold right; copies and order
    of the mix from its own operator."""
    rejected = {row["doc_id"] for row in results("op8_language_id") if row["rejected"]}
    kept = {i: text for i, text in texts.items() if i not in rejected}
    roots = components_of({i: simhash_of(text) for i, text in kept.items()})
    unsafe = {row["doc_id"] for row in results("op5_decontamination") if row["contaminated"]}
    kept = {i for i in kept if roots[i] == i and i not in unsafe}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(
        f"doc_id in ({', '.join(map(str, sorted(kept)))})"
    )
    mixed = sorted(row.doc_id for row in corpus_pipeline.mix_sources(spark, docs, DATA).collect())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted, start = [], 0
    for doc_id in mixed:
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    rows = [
        (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) for row in results("pipeline")
    ]
    assert sorted(rows) == wanted
