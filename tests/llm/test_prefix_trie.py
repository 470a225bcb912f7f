from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from loomwork.llm import prefix_trie
from loomwork.llm.queries import trie_summary

SCHEMA = "conv_id long, turn long, role string, text string, depth string, h1 int"


def brute_force(rows: list[tuple]) -> list[tuple]:
    """Prefix by prefix in plain Python."""
    said: dict[int, list] = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(turns)] for c, turns in said.items()}
    whole = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        source = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(original.get(source, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    for prefix, convs in members.items():
        own = (len(convs) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += not children[prefix]
            saved[prefix[:d]] += own
    out = []
    for prefix, convs in members.items():
        parent = members[prefix[:-1]][0] if prefix else None
        ends = ",".join(str(c) for c in convs if whole[c] == prefix)
        out.append((convs[0], len(prefix), parent, len(convs), children[prefix], leaves[prefix], saved[prefix], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    got = trie_summary(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(rows)


@pytest.mark.parametrize("seed, turns, texts", [(1, 12, 2), (2, 3, 1), (3, 40, 3)])
def test_equals_brute_force(spark, seed, turns, texts):
    deal = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(deal.randint(1, turns)):
            role = "assistant" if turn % 2 else "user"
            rows.append((conv, turn, role, "é" * deal.randrange(texts) + "a", "clash", 7))
    check(spark, rows)


def test_nulls_ties_repeats_and_gaps(spark):
    rows = [
        (None, 1, "user", "nobody", "", 0), (3, None, None, None, "", 0), (3, 5, "user", "x", "", 0), (3, 5, "user", "x", "", 0), (3, 5, "a", "y", "", 0),
        (10, 1, "user", "x", "", 0), (11, 1, "user", "x", "", 0), (12, 1, "user", "x", "", 0), (-3, 2, "user", "", "", 0), (-7, 2, "user", "z" * 70_000, "", 0),
        (10**12 + 1, 0, "user", "x", "", 0),
    ]
    check(spark, rows)


def test_one_long_conversation_and_many_copies(spark):
    rows = [(0, t, "user", f"turn {t % 5}", "", 0) for t in range(300)]
    rows += [(c, t, "user", f"turn {t % 5}", "", 0) for c in range(5, 200) for t in range(3)]
    check(spark, rows)


def test_only_empty_conversations(spark):
    """Their own turns are replaced by those of a conversation that is not there."""
    convs = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:6]
    check(spark, [(c, 0, "user", "gone", "", 0) for c in convs])


def test_empty_table(spark):
    check(spark, [])


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    rounds = []
    named = prefix_trie._named
    monkeypatch.setattr(prefix_trie, "_named", lambda *a: rounds.append(a[2]) or named(*a))
    rows = [(0, t, "user", "x", "", 0) for t in range(500)]
    assert trie_summary(spark.createDataFrame(rows, SCHEMA)).count() == 501 and len(rounds) == 9
