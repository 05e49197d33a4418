"""Prefix trie, conversation repair and sentence pieces: methods, edges, long groups."""

from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256

import duckdb
import public_tokenizers
import pytest
from corpus_fixtures import documents, scratch  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgepulse.llm import conversation_repair, prefix_trie, sentence_pieces
from forgepulse.llm.conversation_repair import Audit, Path, Row, audited, first_difference, follows

PIECES = public_tokenizers.path(sentence_pieces.VOCABULARY)
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
ROWS = [
    (0, 0, "system", "Be brief."), (0, 1, "user", "Why?"), (0, 2, "assistant", "Because."),
    (1, 0, "user", "Why?"), (1, 0, "user", "Why?"), (1, None, None, None), (1, 4, "tool", "so"),
    (2, None, "user", ""), (2, None, "user", ""), (3, 0, "", "no role"), (4, 7, None, "no role."),
    (5, 0, "user", "a " * 40_000), (6, 0, "user", " \t\n"), (-3, 2, "assistant", "late!"), (-3, 1, "user", "Früh?"),
    (10, 0, "user", "Why?"), (10, 1, "assistant", "Because."), (11, 0, "user", "Why?"),
]
CLASHES = ["key", "base", "own", "id", "size", "node", "parent", "part", "at", "gone", "hash", "salt", "copy", "n"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, CONVERSATIONS)


def by_sql(sql, rows):
    duck = duckdb.connect()
    duck.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        duck.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    result = duck.execute(sql)
    return sorted_rows([column[0] for column in result.description], result.fetchall())


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def trie(rows, scratch, **options):  # noqa: F811
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(rows), scratch, **options)
    return sorted_rows(found.columns, found.collect())


def repair(rows, scratch, **options):  # noqa: F811
    found = conversation_repair.repair(conversation_repair.damaged(rows), scratch, gone="gone", **options)
    return sorted_rows(found.columns, found.collect())


def random_conversations(seed, n=60, turns=9):
    rng, rows = random.Random(seed), []
    for conv_id in range(n):
        for turn in range(rng.randint(1, turns)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append((conv_id, turn + rng.randint(0, 1) * turns * (1 + turn), role, rng.choice("abc") + rng.choice(["", ".", " ?"])))
    return rows


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")], ROWS, random_conversations(1), random_conversations(2, 8, 90)])
def test_trie_equals_sql(spark, scratch, rows):  # noqa: F811
    wanted = by_sql(prefix_trie.ORACLE, rows)
    frame = conversations(spark, rows)
    for options in ({}, {"keys": 2}, {"keys": 3, "ends_chars": 3}):
        assert trie(frame, scratch, **options) == wanted
    assert trie(frame.withColumns({name: F.lit("x") for name in CLASHES}), scratch) == wanted


@pytest.mark.parametrize("rows", [[], ROWS, random_conversations(3), random_conversations(4, 8, 90)])
def test_repair_equals_sql(spark, scratch, rows):  # noqa: F811
    wanted = by_sql(conversation_repair.ORACLE, rows)
    frame = conversations(spark, rows)
    for options in ({}, {"piece": 2}, {"piece": 5, "piece_chars": 40}):
        assert repair(frame, scratch, **options) == wanted
    assert repair(frame.withColumns({name: F.lit("x") for name in CLASHES}), scratch) == wanted


def test_equal_conversations_are_one_way(spark, scratch):  # noqa: F811
    """Half of all conversations are alike; their ids are hashed in order over many trees."""
    rows = [(n, t, "user", "same") for n in range(0, 3000, 5) for t in range(3)]
    rows += [(n, t, "user", f"{n} {t}") for n in range(2, 3000, 5) for t in range(2)]
    frame = conversations(spark, rows)
    assert trie(frame, scratch, keys=64, ends_chars=100) == by_sql(prefix_trie.ORACLE, rows)


def test_rows_without_a_conversation(spark, scratch):  # noqa: F811
    rows = [*ROWS, (None, 0, "user", "Who?"), (None, 1, "assistant", "I.")]
    frame = conversations(spark, rows)
    assert trie(frame, scratch) == by_sql(prefix_trie.ORACLE, rows)
    assert repair(frame, scratch) == by_sql(conversation_repair.ORACLE, rows)


def test_layouts_grow_and_paths_are_compressed():
    rng = random.Random(4)
    keys = {bytes([first]) + rng.randbytes(31) for first in range(256)}
    keys |= {b"\x07" * 16 + bytes([second]) + rng.randbytes(15) for second in range(30)}
    keys |= {b"\x07" * 16, b"\x09" * 64, b""}
    tree = prefix_trie.Tree()
    sizes = [1] * 4
    for n, key in enumerate(sorted(keys, key=lambda _: rng.random())):
        tree.insert(key, prefix_trie.End(1, n, "x", sizes))
    assert isinstance(tree.root.layout, prefix_trie.Full)
    fork = tree.root.layout.get(7)
    assert fork.path == b"\x07"
    inner = fork.layout.get(7)
    assert inner.path == b"\x07" * 15 and isinstance(inner.layout, prefix_trie.Indexed)
    assert tree.root.layout.get(9).layout.get(9).path == b"\x09" * 63
    wanted = {key[:end] for key in keys for end in range(0, len(key) + 1, prefix_trie.WIDTH)}
    turns = prefix_trie.turns_of(tree)
    assert len(turns) == len(wanted)
    depths = defaultdict(int)
    for prefix in wanted:
        depths[len(prefix) // prefix_trie.WIDTH] += 1
    assert {d: sum(turn.depth == d for turn in turns) for d in depths} == depths


def plain_audit(rows):
    """Every state's cheapest letters as plain strings."""
    def better(states, state, cost, letters):
        if state not in states or (cost, letters) < states[state]:
            states[state] = cost, letters

    def insert(states):
        for _ in range(3):
            for state, (cost, letters) in list(states.items()):
                better(states, 3 if state == 2 else 2, cost + 3, letters + "I")
        return states

    states = insert({0: (0, "")})
    for row in rows:
        after = {}
        for state, (cost, letters) in states.items():
            better(after, state, cost + 4, letters + "D")
            if not row.must_go:
                extra = 3 * row.truncated
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, row.role[:1]))
                if to is not None:
                    better(after, to, cost + extra, letters + "K")
                better(after, 3 if state == 2 else 2, cost + extra + 3, letters + "R")
        states = insert(after)
    return min(states[state] for state in (0, 3) if state in states)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", ""]), st.sampled_from(["a.", "a", ""])), max_size=14))
def test_audit_equals_plain_strings(turns):
    rows = [Row(n, role, text) for n, (role, text) in enumerate(turns)]
    assert audited(rows) == plain_audit(rows)


def test_paths_compare_like_strings(monkeypatch):
    rng = random.Random(9)

    def check():
        paths, texts = [Path(None, "")], [""]
        for _ in range(400):
            at = rng.randrange(max(0, len(paths) - 30), len(paths))
            letter = rng.choice("DIK")
            paths.append(Path(paths[at], letter))
            texts.append(texts[at] + letter)
        for _ in range(2000):
            a, b = rng.randrange(len(paths)), rng.randrange(len(paths))
            same = next((i for i, (x, y) in enumerate(zip(texts[a], texts[b])) if x != y), None)
            found = first_difference(paths[a], paths[b])
            assert (found and found[0].depth - 1) == same
            if same is not None:
                assert follows(paths[a], "K", paths[b], "K") == (texts[b] < texts[a])

    check()
    # Every hash collides: the letters decide.
    monkeypatch.setattr(conversation_repair, "MODULUS", 1)
    check()
    monkeypatch.setattr(conversation_repair, "MODULUS", 3)
    check()


def test_long_audit_shares_its_paths():
    audit = Audit()
    for n in range(20_000):
        audit.take("uas"[n % 3], n % 7 == 0, n % 5 == 0)
    cost, path = min((best for best in audit.best if best), key=lambda best: best[0])
    assert path.depth >= 20_000 and len(path.up) == path.depth.bit_length() and cost > 0


def test_edits_give_the_repaired_turns(spark, scratch):  # noqa: F811
    rows = random_conversations(5)
    frame = conversations(spark, rows).withColumn("gone", F.lit(False))
    found = conversation_repair.repair(frame, scratch).collect()
    audits = spark.createDataFrame([(row.conv_id, row.audit) for row in found], "conv_id bigint, audit string")
    numbered = defaultdict(list)
    hashed = frame.select("*", F.xxhash64("text").alias("hash")).collect()
    for row in sorted(hashed, key=lambda row: (row.conv_id, row.turn, row.role, row.hash)):
        numbered[row.conv_id].append(row)
    turns = defaultdict(list)
    for edit in sorted(conversation_repair.edits(audits).collect(), key=lambda edit: (edit.conv_id, edit.place)):
        row = None if edit.at is None else numbered[edit.conv_id][edit.at]
        turns[edit.conv_id].append(f"{edit.new_role or row.role}:{row.text if row else ''}")
    for row in found:
        assert row.repaired_sha256 == sha256("\n".join(turns[row.conv_id]).encode()).hexdigest()


PARTS = [
    " ", " ", "\n", "\t", "a", "the", "é", "ß", "'s", "1", "23", ".", "<s>", "<unk>", "<0x0A>", "中文", " ",
    "　", "▁", "😀", "\0", "\r", "\r\n", "́", ");", "{\r", "ing", "tion", "ﬁ", "\U0010ffff", "﻿",
]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=3), max_size=12))
def test_agenda_equals_the_library(parts):
    encoder, text = sentence_pieces._encoder(PIECES, 100), "".join(parts)
    assert encoder.encode([text])[0].tolist() == encoder.library.encode(text)


def test_long_words_use_the_heap():
    rng = random.Random(2)
    encoder = sentence_pieces.Encoder(PIECES)
    for size in (64, 65, 5000, 200_000):
        word = "".join(rng.choice("abcdeinrst") for _ in range(size))
        assert encoder.encode([word])[0].tolist() == encoder.library.encode(word)
        assert size > 5000 or encoder._heap_merged(word) == encoder._list_merged(word)


def test_a_disagreement_fails():
    encoder = sentence_pieces.Encoder(PIECES)
    encoder.ranks.pop("▁the")
    with pytest.raises(sentence_pieces.Disagreement):
        encoder.encode(["the thing"])


def test_pieces_of_any_rows(spark, documents, scratch):  # noqa: F811
    rows = [
        (1, None), (2, ""), (3, "word " * 50_000), (4, "same"), (4, "same"), (None, "no id"), (5, " \n "),
        (6, "x" * 100_000),
    ]
    docs = documents(rows).withColumns({"ids": F.lit("x"), "n_tokens": F.lit("x")})
    coded = sentence_pieces.encode(docs, PIECES).collect()
    library = sentence_pieces._encoder(PIECES, 100).library
    assert [row.ids for row in coded] == [library.encode(text or "") for _, text in rows]
    assert coded[0].n_tokens == "x" and coded[0].lang == "en"
    again = sentence_pieces.decode(sentence_pieces.encode(documents(rows), PIECES), PIECES, into="again").collect()
    assert [row.again for row in again] == [text or "" for _, text in rows]
    found = sentence_pieces.described(docs, PIECES).collect()
    assert [(row.doc_id, row.n_tokens) for row in found] == [(i, len(row.ids)) for (i, _), row in zip(rows, coded)]
    assert sentence_pieces.described(documents([]), PIECES).isEmpty()
