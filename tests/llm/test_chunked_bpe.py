from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwork.llm import chunked_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TEXTS = [
    "Hello, it's  a   test.\nNew\n\n line \t x ", "", None, "a <|endoftext|>b", " lead and trail ", "nbsp    mixed \x1cctrl\x1f é日本 🙂",
    "x" * 3000, " " * 1000 + "a" + "\n" * 500, "'ll'll'll'll we'll !'ll they'ree " * 40, "1234567890" * 90 + " end", "\n\nx" * 300, "  a" * 400,
    "日本語テキスト。" * 60, "don't " * 200, "\r\nwin\r\n\r\n end", "é" * 200, "🙂" * 300, "''''''s" * 100, "　　z" * 90, "!!\x1c!!\x1f" * 99, "\u1c89x\u1c89 \ua7cb'" * 70,
]


def library(text: str | None) -> bytes:
    return np.array(chunked_bpe.encoding(RANKS, PATTERN).encode_ordinary(text or ""), "<u4").tobytes()


@pytest.mark.parametrize("chunk, overlap", [(8, 3), (50, 8), (64, 64), (1 << 14, 1 << 9)])
def test_equals_the_library(spark, chunk, overlap):
    rows = [(i, t, "x", 5) for i, t in enumerate(TEXTS)] + [(None, "the null id " * 20, "", 1), (3, "twice " * 30, "", 2), (3, "twice " * 30, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, row int")
    got = chunked_bpe.decode(chunked_bpe.encode(docs, RANKS, PATTERN, chunk, overlap), RANKS, PATTERN)
    assert got.columns == ["doc_id", "ids", "decoded"]
    both = chunked_bpe.encode_and_decode(docs, RANKS, PATTERN, chunk, overlap)
    want = [(name, library(text), (text or "").encode()) for name, text, *_ in rows]
    for df in (got, both):
        assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in df.collect()), key=repr) == sorted(want, key=repr)


def test_a_long_text_goes_to_many_pieces(spark):
    text = "Some words of a text, and more. " * 3000
    pieces = chunked_bpe.pieces(spark.createDataFrame([(0, 7, text)], "row long, doc_id long, text string"), PATTERN, 1000, 100).orderBy("begin").collect()
    assert "".join(p.text for p in pieces) == text
    assert len(pieces) == 96 and max(len(p.text) for p in pieces) < 1200


def test_one_pre_token_over_many_chunks(spark):
    text = "start " + "q" * 20_000 + " end of it " + "- " * 3000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert bytes(chunked_bpe.encode(docs, RANKS, PATTERN, 512, 64).first().ids) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab'slrve1 2\n\t.!é ")), max_size=60), st.integers(3, 9))
def test_any_cut_resynchronises_right(text, chunk):
    """The places where neighbours meet are ends of pre-tokens of the whole text, whatever it is."""
    import pyarrow as pa
    import regex

    overlap = 3
    table = pa.RecordBatch.from_pydict({"row": pa.array([0]), "doc_id": pa.array([0]), "text": [text]})
    chunks = list(chunked_bpe._chunks(iter([table]), chunk, overlap)) if text else []
    ends = [row for batch in chunked_bpe._ends(iter(chunks), PATTERN, overlap) for row in batch.to_pylist()]
    # A chunk is only right behind a true place, so neighbours count as long as all before them met.
    true = {m.end() for m in regex.finditer(PATTERN, text)}
    for a, b in zip(ends, ends[1:]):
        common = set(a["tail"]) & set(b["head"])
        if not common:
            break
        assert b["begin"] + min(common) in true


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert chunked_bpe.decode(chunked_bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect() == []


def test_bad_overlap(spark):
    with pytest.raises(ValueError):
        chunked_bpe.pieces(spark.range(0).select(F.col("id").alias("row"), F.col("id").alias("doc_id"), F.lit("").alias("text")), PATTERN, 10, 11)
