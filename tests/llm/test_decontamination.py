from __future__ import annotations

import random
import re

import pytest

from loomwork.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_force(documents, items, window):
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(len(w), window)
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(name)
    out = []
    for doc_id, text in documents:
        w, hit, names = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    names |= found
        out.append((doc_id, len(w), len(hit), sorted(str(n) for n in names if n is not None)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("window,limit", [(1, 100), (3, 100), (3, 7), (4, 15)])
def test_equals_brute_force(spark, monkeypatch, window, limit):
    random.seed(window * limit)
    vocabulary = ["a", "B", "c1", "é", "the"]
    text = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, text(random.randint(0, 9))) for i in range(6)] + [(2, "a a a a"), (None, "B B B B B"), (9, None)]
    documents = [(i, text(random.randint(0, 40))) for i in range(40)] + [(7, None), (7, ""), (None, "a, b; C1 é"), (3, "x")]
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(decontamination.contamination(docs, bench, window, limit)) == brute_force(documents, items, window)


def test_long_items_come_in_overlapping_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(decontamination, "PIECE_WORDS", 4)
    item = " ".join(f"w{i}" for i in range(11))
    batch = pa.RecordBatch.from_pydict({"item_id": [1], "text": [item]}, pa.schema([("item_id", pa.int64()), ("text", pa.string())]))
    pieces = [w.split() for b in decontamination._pieces(iter([batch]), 3) for w in b.column("words").to_pylist()]
    windows = {tuple(p[i : i + 3]) for p in pieces for i in range(len(p) - 2)}
    every = item.encode().split()
    assert windows == {tuple(every[i : i + 3]) for i in range(9)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert result(decontamination.contamination(docs, bench)) == [(1, 3, 0, [])]
    assert result(decontamination.contamination(docs.where("false"), bench.unionByName(bench))) == []


def test_passages_are_cut_and_columns_stay(spark):
    passage = "One two, three four five six seven eight nine ten eleven"
    rest = " ".join(f"Word{i}." for i in range(30))
    rows = [(1, f"{rest} >> {passage}! End of it.", "x", "h"), (2, passage, "y", None), (3, rest, None, "i"), (4, None, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string, items string")
    bench = spark.createDataFrame([(5, passage.upper())], "item_id long, text string")
    out = decontamination.decontaminated(docs, bench)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=repr) == [(1, f"{rest} >> ! End of it.", "x", "h"), (3, rest, None, "i"), (4, None, "z", None)]
