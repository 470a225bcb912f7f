"""Cross-entropy difference: how much more a text resembles a target corpus than the background.

The background is every document, the target those the caller names. Both models are word bigrams over one vocabulary,
every distinct word of all documents and two places for unknown words and the beginning of a text, with the same
smoothing: absolute discounting that backs off to add-one unigrams. The score of a text is its mean loss per token under
the target model less that under the background model; texts like the target have low scores.

Words are told apart by 64-bit hashes, pairs of neighbours by both hashes. Nearly every pair of a corpus is rare, so rows
of single pairs would outweigh the texts many times; questions and answers therefore travel as packed columns.

1. Texts meet the target ids, then some ``CHUNK`` tokens of whole texts become one row: the distinct words, and the texts
   as numbers into them. Chunks are written once.
2. A chunk asks for its distinct pairs: one row for each bucket of pairs, with the chunk's own counts. A bucket adds up
   what all chunks ask, answers each with the counts of its pairs, and tells how many kinds of words follow each context.
3. In the same way it asks for its distinct words, by buckets of words, and the kinds of step 2 join in. The answer has
   the totals of a word as context and as word.
4. A chunk and its answers meet by the chunk's number, and it adds the losses of each of its texts.

A context belongs to one bucket, so that it is sent once with all words after it, but for words that may make up a
``COMMON_WORDS``-th of all tokens: these are spread by the word that follows. A word that common must be that common in some chunk, so
only such words are counted to find them, and there are at most 2 * ``COMMON_WORDS``. This list is all that is broadcast.
Buckets grow in number with the tokens, not in size. The counts of every pair and word take part.

Defined results: a NULL or empty text has no tokens and NULL scores; rows are scored one by one; without any target text
the target model is uniform. A text is never cut: one of more than ``CHUNK`` tokens makes a chunk of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.arrow_rows import slices, utf8
from loomwork.llm.decontamination import normalised_words
from loomwork.llm.near_dedup import mixed
from loomwork.staging import staged

UNKNOWN, BEGINNING = 0, 1
DISCOUNT = 0.75
#: A context of a larger share of all tokens is spread over buckets.
COMMON_WORDS = 1 << 16
#: Tokens and texts of a chunk, tokens for each bucket.
CHUNK, CHUNK_TEXTS, BUCKET = 1 << 21, 1 << 16, 1 << 22
_ROWS = 500
_HELD_WORDS = 1 << 19
_TURN = np.uint64(0x9E3779B97F4A7C15)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in utf8(batch, "text"):
            counts.update(normalised_words(text))
            if len(counts) > _HELD_WORDS:
                yield told()
                counts.clear()
    yield told()


def vocabulary(documents: DataFrame, size: int) -> frozenset[bytes]:
    """The ``size`` - 2 most frequent words, ties by the word."""
    counted = documents.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return frozenset(bytes(row.word) for row in counted.orderBy(F.desc("n"), "word").limit(size - 2).collect())


class _Hashes(dict):
    """64-bit hashes of words, those outside ``known`` as ``UNKNOWN``."""

    def __init__(self, known: frozenset[bytes] | None):
        self.known = known

    def __missing__(self, word: bytes) -> int:
        if len(self) > _HELD_WORDS:
            self.clear()
        told = self.known is None or word in self.known
        self[word] = found = int.from_bytes(blake2b(word, digest_size=8).digest(), "little") if told else UNKNOWN
        return found


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, compressed."""
    sizes = np.array([len(columns), *map(len, columns)], "<u8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(x, "<u8").tobytes() for x in (sizes, *columns)))


def unpacked(blob: bytes) -> list[np.ndarray]:
    numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u8")
    n = int(numbers[0])
    return np.split(numbers[n + 1 :], np.cumsum(numbers[1 : n + 1].astype(np.int64))[:-1])


_CHUNK = "words binary, numbers binary, doc_ids array<long>, lengths array<long>, targets array<boolean>"


def _chunks(batches: Iterator[pa.RecordBatch], shared, most: int) -> Iterator[pa.RecordBatch]:
    """Whole texts of some tokens as one row. Frequent words have low numbers, and bytes of one rank lie together."""
    number = _Hashes(shared.value if shared else None)
    press = zstandard.ZstdCompressor(level=3)
    held: list[tuple] = []
    n = 0

    def told() -> pa.RecordBatch:
        tokens = np.concatenate([x[0] for x in held])
        words, at, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(words), "<u4")
        place[order] = np.arange(len(words))
        planes = np.ascontiguousarray(place[at].view(np.uint8).reshape(-1, 4).T)
        blobs = [pa.array([x], pa.binary()) for x in (packed(words[order]), press.compress(planes.tobytes()))]
        lists = [pa.array([x], pa.list_(kind)) for x, kind in (([x[1] for x in held], pa.int64()), ([len(x[0]) for x in held], pa.int64()), ([x[2] for x in held], pa.bool_()))]
        return pa.RecordBatch.from_arrays([*blobs, *lists], ["words", "numbers", "doc_ids", "lengths", "targets"])

    for whole in batches:
        for batch in slices(whole, _ROWS):
            for text, name, target in zip(utf8(batch, "text"), batch.column("doc_id").to_pylist(), batch.column("target").to_pylist()):
                words = normalised_words(text)
                held.append((np.fromiter(map(number.__getitem__, words), dtype="<u8", count=len(words)), name, target))
                n += len(words)
                if n >= most or len(held) >= CHUNK_TEXTS:
                    yield told()
                    held.clear()
                    n = 0
    if held:
        yield told()


class Size(NamedTuple):
    """Words of the vocabulary, tokens of background and target, buckets."""

    words: int
    b: int
    t: int
    buckets: int


class Chunk:
    """The distinct pairs and words of a chunk, with its counts, in the order in which buckets are asked for them."""

    def __init__(self, words: bytes, numbers: bytes, lengths: list[int], targets: list[bool]):
        self.words = np.append(unpacked(words)[0], np.uint64(BEGINNING))
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(numbers), np.uint8).reshape(4, -1)
        self.word = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
        self.lengths = np.array(lengths, np.int64)
        self.target = np.repeat(np.array(targets, bool), self.lengths)
        self.context = np.concatenate(([0], self.word[:-1])) if len(self.word) else self.word
        starts = np.cumsum(self.lengths) - self.lengths
        self.context[starts[self.lengths > 0]] = len(self.words) - 1

    def _counts(self, at: np.ndarray, n: int) -> list[np.ndarray]:
        return [np.bincount(at, minlength=n), np.bincount(at[self.target], minlength=n)]

    def ask_pairs(self, common: np.ndarray, buckets: int) -> None:
        n = len(self.words)
        pairs, self.pair = np.unique(self.context * n + self.word, return_inverse=True)
        self.pair_context, self.pair_word = np.divmod(pairs, n)
        context, word = self.words[self.pair_context], self.words[self.pair_word]
        spread = np.where(np.isin(context, common), mixed(word + _TURN), np.uint64(0))
        self.pair_bucket = (mixed(context + spread) % np.uint64(buckets)).astype(np.int64)
        self.pair_order = np.argsort(self.pair_bucket, kind="stable")
        self.pair_counts = self._counts(self.pair, len(pairs))

    def ask_words(self, buckets: int) -> None:
        n = len(self.words)
        self.word_bucket = word_buckets(self.words, buckets)
        self.word_order = np.argsort(self.word_bucket, kind="stable")
        self.word_counts = [*self._counts(self.context, n), *self._counts(self.word, n)]


def word_buckets(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(words + _TURN) % np.uint64(buckets)).astype(np.int64)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.concatenate((np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))), [len(values)])) if len(values) else np.zeros(1, np.int64)


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, Chunk]]:
    for i in range(batch.num_rows):
        row = batch.slice(i, 1).to_pylist()[0]
        yield row["chunk"], Chunk(row["words"], row["numbers"], row["lengths"], row["targets"])


_ASKED = "bucket long, chunk long, blob binary"


def _asked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("bucket", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], [x for x, _ in kinds])


def _frequent(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """The words that may be common, with their counts in a chunk."""
    for batch in batches:
        for _, chunk in _read(batch):
            counts = np.bincount(chunk.context, minlength=len(chunk.words))
            at = np.flatnonzero((counts > 0) & (counts * (2 * share) >= len(chunk.word)))
            yield pa.RecordBatch.from_arrays([pa.array(chunk.words[at].view(np.int64)), pa.array(counts[at])], ["h", "n"])


def common_contexts(chunks: DataFrame, tokens: int, share: int) -> np.ndarray:
    """Every context of at least a ``share``-th of all tokens, and at most twice as many words as that."""
    counted = chunks.mapInArrow(partial(_frequent, share=share), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") * (2 * share) >= tokens).select("h").toArrow()
    return np.sort(rows.column("h").to_numpy().astype(np.int64).view(np.uint64))


def _ask_pairs(batches: Iterator[pa.RecordBatch], shared, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, chunk in _read(batch):
            chunk.ask_pairs(shared.value, buckets)
            ends = _runs(chunk.pair_bucket[chunk.pair_order])
            for start, end in zip(ends[:-1], ends[1:]):
                at = chunk.pair_order[start:end]
                heads = _runs(chunk.pair_context[at])
                head = chunk.words[chunk.pair_context[at[heads[:-1]]]]
                blob = packed(head, np.diff(heads), chunk.words[chunk.pair_word[at]], *(x[at] for x in chunk.pair_counts))
                yield _asked([(int(chunk.pair_bucket[at[0]]), name, blob)])


def _ask_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, chunk in _read(batch):
            chunk.ask_words(buckets)
            ends = _runs(chunk.word_bucket[chunk.word_order])
            for start, end in zip(ends[:-1], ends[1:]):
                at = chunk.word_order[start:end]
                none = np.zeros(len(at), np.int64)
                yield _asked([(int(chunk.word_bucket[at[0]]), name, packed(chunk.words[at], *(x[at] for x in chunk.word_counts), none, none))])


def _by(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one key after the other; the rows come sorted by it."""
    held: list[dict] = []
    for row in chain.from_iterable(batch.slice(i, 1).to_pylist() for batch in batches for i in range(batch.num_rows)):
        if held and held[0][key] != row[key]:
            yield held[0][key], held
            held = []
        held.append(row)
    if held:
        yield held[0][key], held


def _sums(order: np.ndarray, starts: np.ndarray, columns: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums of columns over groups, and the same sums for every row."""
    sums = [np.add.reduceat(x[order], starts[:-1]) for x in columns]
    of = np.empty(len(order), np.int64)
    of[order] = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return sums, [x[of] for x in sums]


PAIRS, WORDS = 1, 2
_TOLD = "kind int, chunk long, bucket long, blob binary, words long"


def _told(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("blob", pa.binary()), ("words", pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], [x for x, _ in kinds])


def _answers(kind: int, bucket: int, rows: list[dict], sizes: list[int], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    end = 0
    for row, size in zip(rows, sizes):
        start, end = end, end + size
        if row["chunk"] is not None:
            yield _told([(kind, row["chunk"], bucket, packed(*(x[start:end] for x in columns)), 0)])


def _answer_pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of pairs to every chunk that asked, and the kinds of words after each context to the buckets of words."""
    for bucket, rows in _by(batches, "bucket"):
        parts = [unpacked(row.pop("blob")) for row in rows]
        context = np.concatenate([np.repeat(head, n.astype(np.int64)) for head, n, *_ in parts])
        word, b, t = (np.concatenate([x[k] for x in parts]) for k in (2, 3, 4))
        sizes = [len(x[2]) for x in parts]
        del parts
        order = np.lexsort((word, context))
        sorted_context, sorted_word = context[order], word[order]
        changed = (sorted_context[1:] != sorted_context[:-1]) | (sorted_word[1:] != sorted_word[:-1])
        starts = np.concatenate(([0], np.flatnonzero(changed) + 1, [len(order)]))
        sums, totals = _sums(order, starts, [b, t])
        yield from _answers(PAIRS, bucket, rows, sizes, totals)
        head = sorted_context[starts[:-1]]
        heads = _runs(head)
        kinds = np.diff(heads), np.add.reduceat((sums[1] > 0).astype(np.int64), heads[:-1])
        head = head[heads[:-1]]
        to = word_buckets(head, buckets)
        by = np.argsort(to, kind="stable")
        ends = _runs(to[by])
        for start, end in zip(ends[:-1], ends[1:]):
            at = by[start:end]
            none = np.zeros(len(at), np.int64)
            yield _told([(WORDS, None, int(to[at[0]]), packed(head[at], none, none, none, none, *(x[at] for x in kinds)), 0)])


def _answer_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of words to every chunk that asked, and how many words of the vocabulary the bucket has."""
    for bucket, rows in _by(batches, "bucket"):
        parts = [unpacked(row.pop("blob")) for row in rows]
        word, *columns = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        sums, totals = _sums(order, _runs(word[order]), columns)
        yield from _answers(WORDS, bucket, rows, [len(x[0]) for x in parts], totals)
        yield _told([(WORDS, None, bucket, None, int((sums[2] > 0).sum()))])


def _in_order(blobs: list[bytes], order: np.ndarray) -> list[np.ndarray]:
    """Columns of answers, which come in the order of the questions, at the places of what was asked."""
    out = []
    for column in zip(*map(unpacked, blobs)):
        placed = np.empty(len(order), np.float64)
        placed[order] = np.concatenate(column)
        out.append(placed)
    return out


def _score(batches: Iterator[pa.RecordBatch], shared, size: Size) -> Iterator[pa.RecordBatch]:
    """The texts of each chunk with their mean losses. Rows come by chunk: the chunk, answers on pairs, answers on words."""
    for _, (row, *answers) in _by(batches, "chunk"):
        chunk = Chunk(row["words"], row["numbers"], row["lengths"], row["targets"])
        texts = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
        losses = {which: np.zeros(len(chunk.lengths)) for which in "tb"}
        if len(texts):
            chunk.ask_pairs(shared.value, size.buckets)
            chunk.ask_words(size.buckets)
            pairs = _in_order([x["blob"] for x in answers if x["kind"] == PAIRS], chunk.pair_order)
            totals = _in_order([x["blob"] for x in answers if x["kind"] == WORDS], chunk.word_order)
            for k, which in enumerate("bt"):
                count, after, own, kinds = pairs[k], totals[k], totals[2 + k], totals[4 + k]
                unigram = ((own + 1) / (getattr(size, which) + size.words))[chunk.pair_word]
                n, kinds = after[chunk.pair_context], kinds[chunk.pair_context]
                bigram = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds * unigram) / np.maximum(n, 1)
                losses[which] = np.bincount(texts, -np.log(np.where(n > 0, bigram, unigram))[chunk.pair], len(chunk.lengths))
        means = [pa.array(x / np.maximum(chunk.lengths, 1), mask=chunk.lengths == 0) for x in losses.values()]
        yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(chunk.lengths), *means], ["doc_id", "n_tokens", "target_loss", "background_loss"])


def _sorted(rows: DataFrame, key: str, *then: str) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key, *then)


def cross_entropy_difference(
    documents: DataFrame, target_ids: DataFrame, size: int | None = None, common_words: int = COMMON_WORDS, chunk: int = CHUNK, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, difference`` of every document.

    ``target_ids`` has the ``doc_id`` of the documents that make the target corpus. The vocabulary is every distinct word;
    a caller who wants a smaller one names its ``size``, and words beyond the most frequent are one unknown word.
    ``common_words``, ``chunk`` and ``bucket`` change where counts are added up, not the result.
    """
    context = documents.sparkSession.sparkContext
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = None if size is None else context.broadcast(vocabulary(texts, size))
    chosen = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(True))
    flagged = texts.join(chosen.hint("merge"), "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    chunks = flagged.mapInArrow(partial(_chunks, shared=known, most=chunk), _CHUNK)
    chunks = staged(chunks.select(F.monotonically_increasing_id().alias("chunk"), "*"))
    n = F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y)
    of_target = F.aggregate(F.arrays_zip("lengths", "targets"), F.lit(0).cast("long"), lambda x, y: x + F.when(y.targets, y.lengths).otherwise(0))
    tokens, in_target = chunks.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.sum(of_target), F.lit(0))).first()
    buckets = 1 + tokens // bucket
    common = context.broadcast(common_contexts(chunks, tokens, common_words))
    asked = chunks.mapInArrow(partial(_ask_pairs, shared=common, buckets=buckets), _ASKED)
    of_pairs = staged(_sorted(asked, "bucket").mapInArrow(partial(_answer_pairs, buckets=buckets), _TOLD))
    asked = chunks.mapInArrow(partial(_ask_words, buckets=buckets), _ASKED)
    kinds = of_pairs.where(F.col("kind") == WORDS).select("bucket", "chunk", "blob")
    of_words = staged(_sorted(asked.unionByName(kinds), "bucket").mapInArrow(_answer_words, _TOLD))
    words = of_words.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0] + 2 if size is None else size
    answers = of_pairs.unionByName(of_words).where("chunk is not null").drop("words")
    met = chunks.withColumn("kind", F.lit(0)).unionByName(answers, allowMissingColumns=True)
    score = partial(_score, shared=common, size=Size(words, tokens, in_target, buckets))
    scored = _sorted(met, "chunk", "kind", "bucket").mapInArrow(score, "doc_id long, n_tokens long, target_loss double, background_loss double")
    return scored.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
