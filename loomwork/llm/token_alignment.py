"""Alignment of the tokens of two tokenizers, and how often their ids meet in the corpus.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece model that puts a space before a text; A
gets that space too, so both cut the same bytes. Places where both end cut a text into groups, and two tokens are linked
where their bytes overlap. The count of a pair of ids is the number of documents that hold it linked.

1. The bytes of some texts at a time are laid end to end with marks where tokens of A and of B end. Running sums of the
   marks give every link and every group of these texts at once.
2. Most links join an id of A to the id of B with the same bytes. That map is computed once from the vocabularies, so
   these pairs are counted in vectors as long as A's vocabulary, one a task, which meet in sums.
3. Only the other pairs are rows: distinct ones of many texts at once are summed in the task and then by one aggregation.
4. Each text adds the counts of its links in its task, from the summed vector and from the commonest other pairs (at most
   ``COMMON_PAIRS`` of them, broadcast). Its remaining pairs are joined with their counts and the sums go back to it.

What is broadcast is bounded by A's vocabulary and ``COMMON_PAIRS`` and decides only where a count is looked up.

Defined results: a NULL or empty text has no tokens, nor has one whose tokens do not spell its bytes (B writes a space for
U+2581); those have zeros and no groups. Special tokens' strings inside texts are plain text. Rows are aligned one by one,
so repeated rows each count as a document, and ids may repeat or be NULL. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomwork.llm.arrow_rows import slices
from loomwork.llm.bpe import pieces
from loomwork.staging import staged

COMMON_PAIRS = 1 << 19
_COUNTED_TOGETHER = 1 << 21
_ROWS = 250
#: Bytes of text aligned at once.
_TOGETHER = 1 << 20
_MARK = "▁"


def _unsettled() -> np.ndarray:
    """Which characters some versions of Unicode have as letters, numbers or white space and others do not."""
    old, found = unicodedata.ucd_3_2_0, np.zeros(sys.maxunicode + 1, dtype=bool)
    for code in range(sys.maxunicode + 1):
        now = unicodedata.category(chr(code))
        found[code] = (now[0] in "LNZ" or now == "Cn") and old.category(chr(code)) == "Cn"
    return found


class Encoder:
    """Ids of whole texts by a byte-level BPE file, special tokens as plain text.

    Where ids rank the merges, the same ids come faster from those ranks. Texts with characters that the pattern might
    class differently there, and all texts of other files, go to the tokenizer itself.
    """

    def __init__(self, path: str, of_id: list[bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        self.ranks, self.unsettled = None, _unsettled()
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary, merges = told["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        made = [vocabulary.get(x + y) for x, y in merges]
        cut = told["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not told["normalizer"]
        if plain and made == list(range(256, 256 + len(merges))):
            ranks = {of_id[i]: i for i in range(256 + len(merges))}
            self.ranks = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.ranks is None or not text.isascii() and self.unsettled[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.ranks.encode_to_numpy(text)


class Aligned(NamedTuple):
    """Numbers of tokens of A and B and of groups, the groups as text, the codes of all links."""

    numbers: tuple[int, int, int]
    groups: bytes
    codes: np.ndarray


class Aligner:
    """Encodes and aligns texts, some at a time."""

    def __init__(self, a: str, b: str):
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        self.bytes_a = pieces(a)
        self.a = Encoder(a, self.bytes_a)
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)]
        self.size_a, self.size_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        # Where several ids of B have the same bytes, one that is no byte token.
        of_bytes = {x: i for i, x in enumerate(self.bytes_b) if self.b.is_byte(i)}
        of_bytes |= {x: i for i, x in enumerate(self.bytes_b) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.identity = np.array([of_bytes.get(x, -1) for x in self.bytes_a])
        # How an id is written inside a group and at its end.
        written = ((self.bytes_a, ",", "|"), (self.bytes_b, ",", ";"))
        self.written = [f"{i}{mark}".encode() for table, *marks in written for mark in marks for i in range(len(table))]

    def align(self, texts: list[str | None]) -> list[Aligned | None]:
        """None for a text without tokens."""
        found: list[Aligned | None] = [None] * len(texts)
        given = [k for k, text in enumerate(texts) if text]
        ids_b = self.b.encode([texts[k] for k in given], num_threads=1)
        whole, at, ids_a = [], [], []
        for n, k in enumerate(given):
            text = " " + texts[k]
            data, own = text.encode(), self.a(text)
            if b"".join(map(self.bytes_b.__getitem__, ids_b[n])) == data and b"".join(map(self.bytes_a.__getitem__, own.tolist())) == data:
                whole.append(k)
                ids_a.append(own)
                at.append(n)
        if not whole:
            return found
        flat_a = np.concatenate(ids_a).astype(np.int64)
        flat_b = np.concatenate([np.array(ids_b[n], dtype=np.int64) for n in at])
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        mark_a, mark_b = (np.zeros(int(end_a[-1]) + 1, dtype=bool) for _ in range(2))
        mark_a[end_a], mark_b[end_b] = True, True
        both = mark_a & mark_b
        upto_a, upto_b, upto_both = (np.cumsum(mark, dtype=np.int64) for mark in (mark_a, mark_b, both))
        # Every stretch between ends of either is what two tokens share.
        ends, cuts = np.flatnonzero(mark_a | mark_b), np.flatnonzero(both)
        codes = flat_a[upto_a[ends] - mark_a[ends]] * len(self.bytes_b) + flat_b[upto_b[ends] - mark_b[ends]]
        # The tokens of A stand before those of B in each group.
        group_a, group_b = upto_both[end_a] - both[end_a], upto_both[end_b] - both[end_b]
        order = np.empty(len(flat_a) + len(flat_b), np.int64)
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        order[np.arange(len(flat_a)) + np.concatenate(([0], upto_b[cuts]))[group_a]] = flat_a + n_a * both[end_a]
        order[np.arange(len(flat_b)) + upto_a[cuts][group_b]] = 2 * n_a + flat_b + n_b * both[end_b]
        last = np.cumsum([int(self.size_a[ids].sum()) for ids in ids_a])
        bounds = [[0, *upto[last].tolist()] for upto in (upto_a, upto_b, upto_both)]
        links = [0, *np.searchsorted(ends, last, "right").tolist()]
        for n, k in enumerate(whole):
            (a0, a1), (b0, b1), (g0, g1) = (x[n : n + 2] for x in bounds)
            groups = b"".join(map(self.written.__getitem__, order[a0 + b0 : a1 + b1].tolist()))
            found[k] = Aligned((a1 - a0, b1 - b0, g1 - g0), groups[:-1], codes[links[n] : links[n + 1]].astype(np.uint32))
        return found


@lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def _pressed(codes: np.ndarray, times: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    """Rising codes as differences, and their counts; low and high bytes apart."""
    both = np.concatenate((np.diff(codes, prepend=np.uint32(0)), times)).astype("<u4")
    return press.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpressed(data: bytes, unpress: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(unpress.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.int64), both[half:].astype(np.int64)


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _by_size(texts: list[str | None]) -> Iterator[list[str | None]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _TOGETHER:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    yield texts[start:]


def _aligned(batches: Iterator[pa.RecordBatch], a: str, b: str) -> Iterator[pa.RecordBatch]:
    both, press = aligner(a, b), zstandard.ZstdCompressor(level=1)
    nothing = Aligned((0, 0, 0), b"", np.zeros(0, np.uint32))
    for whole in batches:
        for batch in slices(whole, _ROWS):
            numbers, groups, links = [], [], []
            for some in _by_size(batch.column("text").to_pylist()):
                for found in both.align(some):
                    counts, text, codes = found or nothing
                    numbers.append((*counts, len(codes)))
                    groups.append(press.compress(text))
                    links.append(_pressed(*np.unique(codes, return_counts=True), press))
            columns = [pa.array([n[k] for n in numbers], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(groups, pa.binary()), pa.array(links, pa.binary())],
                ["doc_id", *_NUMBERS, "packed_groups", "links"],
            )


def aligned(documents: DataFrame, a: str, b: str) -> DataFrame:
    """A row for each document: ``row, doc_id, n_a, n_b, n_groups, n_links``, and its groups and links, packed."""
    found = aligner(a, b)
    if len(found.bytes_a) * len(found.bytes_b) > 1 << 32:
        raise ValueError("pairs of these vocabularies do not fit in 32 bits")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, packed_groups binary, links binary"
    rows = texts.mapInArrow(partial(_aligned, a=a, b=b), schema)
    return staged(rows.select(F.monotonically_increasing_id().alias("row"), "*"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    for whole in batches:
        for batch in slices(whole, _ROWS):
            texts = [unpress.decompress(x).decode() for x in batch.column("packed_groups").to_pylist()]
            columns = {c: batch.column(c) for c in batch.schema.names if c != "packed_groups"}
            yield pa.RecordBatch.from_pydict(columns | {"groups": pa.array(texts, pa.string())})


def groups(found: DataFrame) -> DataFrame:
    """The rows of ``aligned`` with ``groups``, ids of A and of B as ``a1,a2|b1;a3|b2``."""
    rows = found.select("row", "doc_id", *_NUMBERS, "packed_groups")
    return rows.mapInArrow(_unpacked, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string")


def _count(batches: Iterator[pa.RecordBatch], identity: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Documents with each pair: same bytes in one vector, other pairs by sorting many texts' pairs at once."""
    unpress, vector = zstandard.ZstdDecompressor(), np.zeros(len(identity), np.int64)
    held: list[np.ndarray] = []
    size = 0

    def told(pair: np.ndarray, n: np.ndarray, exact: bool) -> pa.RecordBatch:
        columns = [pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(np.full(len(pair), exact))]
        return pa.RecordBatch.from_arrays(columns, ["pair", "n", "exact"])

    for batch in batches:
        for data in batch.column("links").to_pylist():
            codes, _ = _unpressed(data, unpress)
            a = codes // width
            exact = identity[a] == codes % width
            vector[a[exact]] += 1
            held.append(codes[~exact].astype(np.uint32))
            size += len(held[-1])
            if size > _COUNTED_TOGETHER:
                yield told(*np.unique(np.concatenate(held), return_counts=True), False)
                held, size = [], 0
    if size:
        yield told(*np.unique(np.concatenate(held), return_counts=True), False)
    met = np.flatnonzero(vector)
    yield told(met * width + identity[met], vector[met], True)


def pair_counts(found: DataFrame, a: str, b: str) -> DataFrame:
    """``pair, exact, n``: the documents that hold each pair of linked ids, ``pair`` being A's id times B's vocabulary
    plus B's id, ``exact`` those of the map of same bytes."""
    maps = aligner(a, b)
    rows = found.select("links").mapInArrow(partial(_count, identity=maps.identity, width=len(maps.bytes_b)), "pair long, n long, exact boolean")
    return rows.groupBy("pair", "exact").agg(F.sum("n").alias("n"))


def _looked_up(batches: Iterator[pa.RecordBatch], shared) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per text: row, codes and their times, counts, and which of them are known here."""
    unpress, (identity, width, exact_n, _, pairs, n) = zstandard.ZstdDecompressor(), shared.value
    for batch in batches:
        for row, data in zip(batch.column("row").to_pylist(), batch.column("links").to_pylist()):
            codes, times = _unpressed(data, unpress)
            a = codes // width
            exact = identity[a] == codes % width
            at = np.minimum(np.searchsorted(pairs, codes), max(0, len(pairs) - 1))
            common = (pairs[at] == codes) if len(pairs) else np.zeros(len(codes), dtype=bool)
            counts = np.where(exact, exact_n[a], n[at] if len(pairs) else 0)
            yield row, codes, times, counts, exact | common


def _own_sums(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    _, width, _, best, *_ = shared.value
    for batch in batches:
        rows = []
        for row, codes, times, counts, known in _looked_up([batch], shared):
            top = known & (counts == best[codes // width])
            rows.append((row, int(times[top].sum()), int((times * counts)[known].sum())))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["row", "n_best", "count_sum"])


def _other_links(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, _ROWS):
            found = [(np.full((~known).sum(), row), codes[~known], times[~known]) for row, codes, times, _, known in _looked_up([batch], shared)]
            columns = [pa.array(np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)])) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "pair", "times"])


def commonest(rows: DataFrame, count: Column, most: int) -> DataFrame:
    """The rows of the highest counts, as many as come to at most ``most``: by a bound on the count, not by sorting."""
    level = F.floor(F.log2(count.cast("double")) * 8).cast("int")
    at, taken = None, 0
    for row in sorted(rows.groupBy(level.alias("level")).count().collect(), reverse=True):
        taken += row["count"]
        if taken > most:
            break
        at = row.level
    return rows.where(F.lit(False) if at is None else level >= at)


def scored(found: DataFrame, counts: DataFrame, a: str, b: str, common_pairs: int = COMMON_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` in parts to be summed by row: links whose count is the highest of their A id (ties
    included), and the counts of all links. ``counts`` is ``pair_counts``, staged."""
    maps = aligner(a, b)
    width = len(maps.bytes_b)
    of_a = F.floor(F.col("pair") / width).cast("long")
    best = staged(counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("best")))
    dense = {}
    for name, rows in (("exact", counts.where("exact").select(of_a.alias("a"), "n")), ("best", best)):
        table = rows.toArrow()  # at most a row for each id of A
        dense[name] = np.zeros(len(maps.bytes_a), np.int64)
        dense[name][table.column(0).to_numpy()] = table.column(1).to_numpy()
    others = counts.where("not exact")
    common = commonest(others, F.col("n"), common_pairs).select("pair", "n").toArrow().sort_by("pair")
    shared = found.sparkSession.sparkContext.broadcast(
        (maps.identity, width, dense["exact"], dense["best"], common.column("pair").to_numpy(), common.column("n").to_numpy())
    )
    links = found.select("row", "links")
    own = links.mapInArrow(partial(_own_sums, shared=shared), "row long, n_best long, count_sum long")
    rest = links.mapInArrow(partial(_other_links, shared=shared), "row long, pair long, times long")
    topped = others.join(F.broadcast(best), of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("best")).alias("top"))
    met = rest.join(topped.hint("merge"), "pair").select("row", F.when(F.col("top"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    return own.unionByName(met)
