from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from loomwork.llm import lm_scoring

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_force(rows, targets, size):
    texts = [(name, WORD.findall((text or "").lower())) for name, text in rows]
    counts = Counter(w for _, words in texts for w in words)
    known = {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[: size - 2]}
    plain = [(name, [w if w in known else "<unk>" for w in words]) for name, words in texts]

    def model(corpus):
        pairs, words = Counter(), Counter()
        for tokens in corpus:
            pairs.update(zip(["<s>", *tokens], tokens))
            words.update(tokens)
        totals, kinds = Counter(), Counter()
        for (u, _), n in pairs.items():
            totals[u] += n
            kinds[u] += 1

        def loss(u, w):
            unigram = (words[w] + 1) / (sum(words.values()) + size)
            if not totals[u]:
                return -math.log(unigram)
            return -math.log((max(pairs[u, w] - 0.75, 0) + 0.75 * kinds[u] * unigram) / totals[u])

        return loss

    target = model([t for name, t in plain if name in targets])
    background = model([t for _, t in plain])
    out = []
    for name, tokens in plain:
        means = [sum(m(u, w) for u, w in zip(["<s>", *tokens], tokens)) / len(tokens) if tokens else None for m in (target, background)]
        out.append((name, len(tokens), *means, means[0] - means[1] if tokens else None))
    return out


def check(spark, rows, targets, size):
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, difference double").repartition(3)
    ids = spark.createDataFrame([(t,) for t in targets] * 2 + [(None,)], "doc_id long")
    got = [tuple(r) for r in lm_scoring.cross_entropy_difference(docs, ids, size).collect()]
    key = lambda r: (repr(r[0]), r[1], r[2] or 0)
    for mine, theirs in zip(sorted(got, key=key), sorted(brute_force(rows, set(targets), size), key=key), strict=True):
        assert mine[:2] == theirs[:2]
        assert mine[2:] == (pytest.approx(theirs[2:], abs=1e-5) if theirs[1] else theirs[2:])


def test_equals_brute_force(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(12)] + ["É", "b.c", "THE"]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 30)))) for i in range(50)]
    rows += [(100, None), (101, ""), (None, "the the w1"), (5, "w1 w2"), (5, "w1 w2")]
    check(spark, rows, [0, 3, 5, 7, 100, 999], 8)


def test_without_target_and_without_documents(spark):
    check(spark, [(1, "a b c"), (2, None)], [], 5)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scoring.cross_entropy_difference(empty, empty.select("doc_id")).collect() == []


def test_texts_like_the_target_score_lower(spark):
    rows = [(i, "red green blue " * 5 if i % 2 else "one two three " * 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = lm_scoring.cross_entropy_difference(docs, docs.where("doc_id % 4 = 1").select("doc_id")).collect()
    assert max(r.difference for r in scores if r.doc_id % 2) < min(r.difference for r in scores if not r.doc_id % 2)


@pytest.mark.parametrize("common, chunk, bucket", [(1 << 16, 1 << 21, 1 << 22), (4, 300, 100), (1, 1, 7), (100, 700, 50)])
def test_every_word_has_its_own_losses(spark, common, chunk, bucket):
    """Without a size no word is unknown, however texts lie in chunks and words and pairs in buckets."""
    random.seed(4)
    words = [f"w{i}" for i in range(6)] + ["the"] * 6
    rows = [(i, " ".join([f"rare{j}" for j in range(60 * i, 60 * i + 60)] + random.choices(words, k=20))) for i in range(40)]
    rows += [(100, None), (None, "rare1 the rare1 the rare1 the"), (7, "the rare1"), (7, "the rare1")]
    targets = [0, 3, 7, 100]
    size = 2 + len({w for _, text in rows for w in WORD.findall(text or "")})
    assert size > 2048
    want = sorted(brute_force(rows, set(targets), size), key=repr)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lm_scoring.cross_entropy_difference(docs, spark.createDataFrame([(t,) for t in targets], "doc_id long"), None, common, chunk, bucket)
    for mine, theirs in zip(sorted((tuple(r) for r in got.collect()), key=lambda r: repr(r[:2])), sorted(want, key=lambda r: repr(r[:2])), strict=True):
        assert mine[:2] == theirs[:2]
        assert mine[2:] == (pytest.approx(theirs[2:], abs=1e-5) if theirs[1] else theirs[2:])
