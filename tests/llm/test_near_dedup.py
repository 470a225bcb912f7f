from __future__ import annotations

import random
import re

import numpy as np
import pytest

from loomwork.llm import near_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(rows):
    sets = [(name, shingles(text)) for name, text in rows]
    root = {name: name for name, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and None not in (a, b) and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(((a, len(x), find(a), find(a) == a) for a, x in sets), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, groups, copies):
    random.seed(seed)
    passage = [f"shared{i}" for i in range(30)]
    rows, name = [], 0
    for g in range(groups):
        base = [f"w{random.randint(0, 400)}" for _ in range(random.randint(3, 150))]
        base = base + passage if g % 3 == 0 else base
        for _ in range(copies):
            words = base[:]
            for _ in range(random.choice([0, 0, 1, 2, 4, 8])):
                words[random.randrange(len(words))] = f"e{random.randint(0, 99)}"
            rows.append((name, " ".join(words).title() if random.random() < 0.3 else "\t ".join(words)))
            name += 1
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = corpus(block, 12, 14) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "ONE  two"), (1005, "one two three"), (1006, "é É é É é É")]
    docs = spark.createDataFrame([(a, b, 0, True) for a, b in rows], "doc_id long, text string, n_shingles int, kept boolean")
    assert result(near_dedup.near_duplicates(docs)) == brute_force(rows)


def test_rows_without_id_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (3, text + " more"), (None, text), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(near_dedup.near_duplicates(docs))
    assert got == sorted([(5, 36, 3, False)] * 2 + [(3, 37, 3, True), (None, 36, None, True)] + [(8, 0, 8, True)] * 2, key=repr)
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert result(kept) == sorted([(3, text + " more"), (None, text), (8, None)], key=repr)


def confirmed_units(monkeypatch):
    """The tables of units, in the order they are made: of buckets, then of clusters."""
    made, in_units = [], near_dedup._in_units
    monkeypatch.setattr(near_dedup, "_in_units", lambda rows: made.append(rows) or in_units(rows))
    return made


def test_repeated_rows_come_to_a_unit_once(spark, monkeypatch):
    made = confirmed_units(monkeypatch)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(5, text)] * 700 + [(3, text + " more")], "doc_id long, text string")
    assert set(map(tuple, near_dedup.near_duplicates(docs).collect())) == {(5, 36, 3, False), (3, 37, 3, True)}
    assert made[1].count() == 2


def test_blocks_are_cut_by_classes_not_ids(spark, monkeypatch):
    """One id with many different texts, one of them near another document."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    made = confirmed_units(monkeypatch)
    texts = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(200)]
    docs = spark.createDataFrame([(5, t) for t in texts] + [(3, texts[70] + " more")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()} == {(5, 3), (3, 3)}
    assert max(r["count"] for r in made[1].groupBy("unit", "i", "j").count().collect()) < 60


def some_text(name: str) -> str:
    return " ".join(f"{name}{i}" for i in range(40))


def test_deduplication_looks_at_texts_not_ids(spark):
    """Unlike texts of one id all stay, whatever other texts of the id are copies of."""
    rows = [(3, "a"), (5, "a"), (5, "b"), (7, "c"), (7, "d")]
    docs = spark.createDataFrame([(i, some_text(t)) for i, t in rows], "doc_id long, text string")
    assert result(near_dedup.deduplicated(docs)) == sorted(((i, some_text(t)) for i, t in rows if (i, t) != (5, "a")), key=repr)
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()} == {(3, 3), (5, 3), (7, 7)}


def test_repeated_ids_with_unlike_equal_and_near_texts(spark):
    near = some_text("e") + " more"
    rows = [(9, near, 1), (9, some_text("e"), 2), (9, some_text("f"), 3), (9, some_text("f"), 3), (9, some_text("f"), 4), (2, near, 5), (9, "", 6), (9, None, 7), (9, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int")
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(2, near), (9, some_text("f")), (9, ""), (9, "")])
    again = near_dedup.deduplicated(docs.repartition(5))
    assert result(again) == result(kept)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(docs).collect() == []


def test_sets_of_words_split_over_calls():
    texts = [b"A b c d e f", b"", None, b"a b", b"x y\x0bz\x0cq\rr\ns t"]
    sizes = [len(s) for s in near_dedup.shingle_sets(texts)]
    assert sizes == [2, 0, 0, 1, 3]
    alone = near_dedup.shingle_sets([b"a b c d e f"])[0]
    assert (near_dedup.shingle_sets(texts)[0] == alone).all()


def test_long_texts_and_words_hash_alike_in_any_piece(monkeypatch):
    random.seed(8)
    words = ["".join(random.choices("abc", k=random.choice([1, 5, 300]))) for _ in range(400)]
    text = " ".join(words).encode()
    whole = near_dedup.shingle_sets([b"x y", text, text[: len(text) // 2]])
    assert len(whole[1]) == len(shingles(text.decode()))
    monkeypatch.setattr(near_dedup, "_PIECE", 64)
    for mine, theirs in zip(near_dedup.shingle_sets([text, b"x y"]), (whole[1], whole[0])):
        assert (mine == theirs).all()


def test_signatures_estimate_similarity():
    values = np.random.default_rng(3).integers(0, 1 << 63, 3000, dtype=np.uint64)
    errors = []
    for k in range(30):
        some = np.random.default_rng(k).permutation(values)
        a, b = np.sort(some[:400]), np.sort(some[100:500])
        signed = near_dedup.super_min_hash([a, b])
        assert ((signed >> np.uint64(32)) < near_dedup.POSITIONS).all()
        errors.append((signed[0] == signed[1]).mean() - 300 / 500)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.05


def test_every_shingle_ranks_every_position_once():
    """A set of one element has each rank at one position."""
    signed = near_dedup.super_min_hash([np.array([k * 7919 + 1], dtype=np.uint64) for k in range(20)])
    for row in signed >> np.uint64(32):
        assert sorted(row.tolist()) == list(range(near_dedup.POSITIONS))
