from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomwork.llm import bpe

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Hello, it's  a   test.\nNew\n\n line \t x ", "", None, "a <|endoftext|>b  <|endoftext|> c<|endoftext|>", " lead and trail ",
    "nbsp   \n mixed space \x1cctrl\x1f é日本 🙂", "x" * 2000, "the the the rare1 the rare2 the rare1", "\n", "  ",
    "the rare2 rare3 " * 300, "\r\nwin\r\n\r\n end",
]


@pytest.mark.parametrize("frequent", [3, 1 << 19])
def test_equals_the_library(spark, frequent):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "the null id", ""), (3, "twice rare9", ""), (3, "twice rare9", ""), (3, "other", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs, TOKENIZER, frequent), TOKENIZER)
    assert got.columns == ["doc_id", "ids", "decoded"]
    library = Tokenizer.from_file(TOKENIZER)
    want = []
    for name, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((name, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_copies_send_their_words_once(spark):
    """What a key gathers is bounded by one text, however many rows repeat it."""
    text = " ".join(f"rare{i}x" for i in range(50))
    rows = [(1, text)] * 300 + [(None, text + " end")] * 200 + [(2, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined, _ = bpe._joined(docs, TOKENIZER, 3)
    assert max(len(r.rare) for r in joined.select("rare").collect()) <= len(bpe.Words(TOKENIZER)(text + " end"))
    got = bpe.encode_and_decode(docs, TOKENIZER, 3).select("doc_id", "decoded").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER).collect() == []


def test_words_join_to_the_text():
    cut = bpe.Words(TOKENIZER)
    for text in TEXTS:
        assert "".join(cut(text)) == (text or "")
