from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomwork.llm import token_files
from loomwork.staging import staging_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, World. It's 2024!\nNew line, ok.", "", None, "J̌x and İstanbul. 'tis  <|endoftext|> x<|startoftext|>y",
    "tab\tand nbsp … “quoted”. é. È, ÷. a,b.c ... !!. x", "<|ENDOFTEXT|>. A", "日本語 テキスト。 ok", "x" * 3000, "\x1c a\x1fb. ",
    "word " * 5000, ". ,", ",",
]


@pytest.mark.parametrize("bits", range(1, 33))
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype("<u4")
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (token_files.unpack(packed, bits, 0, 1001) == ids).all()
    assert (token_files.unpack(packed, bits, 313, 77) == ids[313:390]).all()


def test_bits():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]


def test_any_stretch_is_read_from_its_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    random = np.random.default_rng(1)
    documents = [(None, random.integers(0, 1000, 10)), (3, random.integers(0, 1000, 500)), (4, np.zeros(0, int)), (9, random.integers(0, 1000, 7))]
    path = tmp_path / "t.bin"
    path.write_bytes(token_files.file_bytes(documents, 10))
    every = np.concatenate([x for _, x in documents])
    file = token_files.TokenFile(str(path))
    assert file.doc_ids == [None, 3, 4, 9] and file.starts.tolist() == [0, 10, 510, 510, 517] and len(file.offsets) == 10
    for start, n in ((0, 517), (63, 2), (64, 64), (100, 300), (516, 1), (5, 0)):
        assert (token_files.read_ids(str(path), start, n) == every[start : start + n]).all()
    path.write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        token_files.TokenFile(str(path))


def test_files_hold_what_the_library_gives(spark):
    rows = [(100 - i, text, i) for i, text in enumerate(TEXTS)] + [(None, "no id", 0), (50, "b", 0), (50, "a", 0), (50, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long")
    files = token_files.write(docs, staging_path(spark), TOKENIZER, 49_408, 1)
    got = [(r.doc_id, r.start, bytes(r.ids)) for r in token_files.read(files).orderBy("start").collect()]
    library = Tokenizer.from_file(TOKENIZER)
    want = {}
    for name, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault(name, []).append(np.array(ids, "<u4").tobytes())
    at = 0
    for name, start, ids in got:
        assert start == at
        assert ids in want[name]
        want[name].remove(ids)
        at += len(ids) // 4
    assert not any(want.values())
    assert [name for name, *_ in got] == sorted((r[0] for r in rows), key=lambda x: -1 if x is None else x)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files = token_files.write(docs, staging_path(spark), TOKENIZER, 49_408, 1)
    assert token_files.read(files).collect() == []
