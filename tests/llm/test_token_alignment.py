from __future__ import annotations

from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomwork.llm import token_alignment
from loomwork.llm.bpe import pieces
from loomwork.llm.queries import alignment_summary
from loomwork.staging import staged

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello, it's  a   test.\nNew\n\n line \t x ", "", None, "a <|endoftext|> b <s> </s> <0x41>", " lead and trail  ", "one\r\ntwo\r\n\r\nthree;\r x",
    "nbsp   mixed  \x1cctrl\x1f é日本 🙂", "x" * 500, "spelled ▁ mark", "aaa aaaa aaaaa", "\n", "  ", "\n\n  end", "tab\tand　wide", "ﬁ é é ﻿​",
    "a\x00b", "word\n Next \n  more", "if (x) {\r\n}\r\n", "the the the the", "The rare1 word, the rare2 word.", "trail \n", "\u0085next line",
]


def brute_force(texts: list[str | None]) -> list[tuple]:
    """Counts per document by whole texts, token by token."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    of_a = pieces(A)
    rows = []
    for text in texts:
        ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        other = b.encode(text, num_threads=1) if text else []
        names = [b.id_to_piece(i) for i in other]
        spelled = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(other, names)]
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(of_a[i] for i in ids) != whole or b"".join(spelled) != whole:
            rows.append(([], [], [], []))
            continue
        spans = []
        for parts, numbers in ((map(of_a.__getitem__, ids), ids), (spelled, other)):
            at, found = 0, []
            for part, i in zip(parts, numbers):
                found.append((at, at + len(part), i))
                at += len(part)
            spans.append(found)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        common = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups = []
        for begin, end in zip([0, *common], common):
            groups.append("|".join(",".join(str(t[2]) for t in s if begin < t[1] <= end) for s in spans))
        rows.append((ids, other, groups, links))
    count = Counter(pair for *_, links in rows for pair in set(links))
    best: dict[int, int] = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [
        (len(i), len(o), len(g), len(k), sum(count[p] == best[p[0]] for p in k), sum(count[p] for p in k), ";".join(g)) for i, o, g, k in rows
    ]


def sha(text: str) -> str:
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest() if text else ""


@pytest.mark.parametrize("common_pairs", [0, 40, 1 << 19])
def test_equals_brute_force(spark, monkeypatch, common_pairs):
    texts = [*TEXTS, *TEXTS[:6], "The rare1 word, the rare2 word."]
    rows = [(i if i % 7 else None, t, "x", -1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, row int").repartition(3)
    got = alignment_summary(docs, A, B, common_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(name, *numbers, sha(groups)) for (name, *_), (*numbers, groups) in zip(rows, brute_force(texts))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy(F.length("text")).limit(60)
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *numbers, sha(groups)) for r, (*numbers, groups) in zip(rows, brute_force([r.text for r in rows]))]
    assert sorted(map(tuple, alignment_summary(spark.createDataFrame(rows), A, B).collect())) == sorted(want)


def test_groups_are_an_output(spark):
    text = "The rare1 word, Éeau chberkeit nten."
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    found = token_alignment.aligned(docs, A, B)
    got = {r.doc_id: r.groups for r in token_alignment.groups(found).collect()}
    assert got == {1: brute_force([text])[0][-1], 2: ""}
    counts = staged(token_alignment.pair_counts(found, A, B))
    assert counts.where("exact").count() and counts.where("not exact").count()


@pytest.mark.parametrize("together", [1, 300, 1 << 20])
def test_texts_together_or_apart(monkeypatch, together):
    monkeypatch.setattr(token_alignment, "_TOGETHER", together)
    both = token_alignment.aligner(A, B)
    found = [x for some in token_alignment._by_size(TEXTS) for x in both.align(some)]
    assert len(found) == len(TEXTS)
    for text, x, (n_a, n_b, n_groups, n_links, *_, groups) in zip(TEXTS, found, brute_force(TEXTS)):
        assert (x is None) == (n_a == 0), text
        assert x is None or (*x.numbers, len(x.codes), x.groups.decode()) == (n_a, n_b, n_groups, n_links, groups)


def test_ranks_and_tokenizer_give_the_same_ids():
    encode = token_alignment.aligner(A, B).a
    assert encode.ranks is not None
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    assert encode.unsettled[0x1C89] and not encode.unsettled[[ord(c) for c in "Ünïcode 日本 🙂 <|endoftext|>"]].any()
    for text in [*TEXTS, "new letters \u1c89x \ua7cb's \U0001e900", "''ll''s 'S"]:
        assert encode(text or "").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment_summary(docs, A, B).collect() == []
