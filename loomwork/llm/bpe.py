"""Byte-level BPE by way of a table of distinct words.

A text is cut into words that the tokenizer merges apart, so its ids are the ids of its words in order. Every distinct
word is encoded once:

1. The words that occur most, counted over all texts, are encoded as a table of at most ``FREQUENT`` rows, which goes to
   every task. A text becomes the ranks of its words in that table.
2. Every other word leaves with its text's key and its position among these words of the text. Equal words meet in one sorted run, are encoded once,
   and the ids go back to their text.
3. Each text joins its ranks with the ids that came back, by position.

Which words are in the table decides only where a word is encoded, never its ids. A hot word is in the table, so no run
is longer than the corpus divided by the table's rows.

Decoding looks every id up in the table of pieces, the bytes of the vocabulary's entries, which each task loads.

Defined results: a NULL or empty text has no ids; every row is encoded for itself, whatever ids repeat (rows whose ids
repeat are told apart by their texts, and of copies one sends its words). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache, partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.arrow_rows import slices
from loomwork.llm.tokenizing import BYTE_LEVEL_WORDS, encoder
from loomwork.staging import discard, staged

#: Rows of the table that goes to every task, and the fewest occurrences in a task that let a word be counted for it.
FREQUENT = 1 << 19
LOCALLY = 3
_HELD_WORDS = 1 << 20
_ROWS = 250
_KEY = "key long, hashed boolean"


class Words:
    """Cuts texts into the words of a byte-level tokenizer; its special tokens are words of their own."""

    def __init__(self, tokenizer: str):
        special = encoder(tokenizer).special
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.special is None or not self.special.search(text):
            return BYTE_LEVEL_WORDS.findall(text)
        parts = self.special.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else BYTE_LEVEL_WORDS.findall(part))]


def _count(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    words, counts = Words(tokenizer), Counter()

    def told() -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if n >= LOCALLY]
        columns = [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(words(text))
            if len(counts) > _HELD_WORDS:
                yield told()
                counts.clear()
    yield told()


def id_type(tokenizer: str) -> str:
    """The narrower of two types that holds every id; in it ids travel between steps."""
    return "<u2" if len(pieces(tokenizer)) <= 1 << 16 else "<u4"


def narrow(ids: list[bytes], kind: str) -> list[bytes]:
    """Ids of words, each in ``kind`` instead of 32 bits."""
    data, size = np.frombuffer(b"".join(ids), "<u4").astype(kind).tobytes(), np.dtype(kind).itemsize
    ends = (np.cumsum([0, *map(len, ids)]) // 4 * size).tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _encode_words(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = narrow(encoder(tokenizer).encode(batch.column("word").to_pylist()), id_type(tokenizer))
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.binary())], ["word", "ids"])


class FrequentWords:
    """Words with their ids by falling count. Travels as Arrow bytes; tasks unfold what they need once a process."""

    def __init__(self, table: pa.Table):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        self.data = sink.getvalue().to_pybytes()

    def __getstate__(self) -> dict:
        return {"data": self.data}

    def _column(self, name: str) -> list:
        return pa.ipc.open_stream(self.data).read_all().column(name).to_pylist()

    @cached_property
    def rank(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self._column("word"), 1)}

    @cached_property
    def ids(self) -> list[bytes]:
        return [b"", *self._column("ids")]  # words outside the table have rank 0


def _frequent(texts: DataFrame, tokenizer: str, rows: int) -> FrequentWords:
    """The words that occur most, with their ids."""
    counted = texts.mapInArrow(partial(_count, tokenizer=tokenizer), "word string, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(rows)
    table = staged(top.select("word").mapInArrow(partial(_encode_words, tokenizer=tokenizer), "word string, ids binary"))
    found = FrequentWords(table.toArrow())
    discard(table)
    return found


def _rare(batches: Iterator[pa.RecordBatch], tokenizer: str, table) -> Iterator[pa.RecordBatch]:
    """Key and word of the words outside the table, and the position among those of the text."""
    words, rank = Words(tokenizer), table.value.rank
    for whole in batches:
        for batch in slices(whole, _ROWS):
            key, position, found = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                others = [word for word in words(text) if word not in rank]
                key += [row] * len(others)
                position += range(len(others))
                found += others
            keys = batch.select(["key", "hashed"]).take(pa.array(key, pa.int64()))
            columns = [*keys.columns, pa.array(position, pa.int32()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "hashed", "position", "word"])


def _encode_runs(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Replace the words of rows in order of words by their ids, each distinct word once."""
    last: tuple[str | None, bytes] = (None, b"")
    for batch in batches:
        words = batch.column("word").dictionary_encode()
        new = words.dictionary.to_pylist()
        ids = [last[1]] if new and new[0] == last[0] else []
        ids += narrow(encoder(tokenizer).encode(new[len(ids) :]), id_type(tokenizer))
        if new:
            last = new[-1], ids[-1]
        found = pa.array(ids, pa.binary()).take(words.indices)
        columns = [*(batch.column(c) for c in ("key", "hashed", "position")), found]
        yield pa.RecordBatch.from_arrays(columns, ["key", "hashed", "position", "ids"])


def _ranked(batches: Iterator[pa.RecordBatch], tokenizer: str, table) -> Iterator[pa.RecordBatch]:
    """Each text as the ranks of its words from 1 on, 0 for those outside the table; low, middle and high bytes apart."""
    words, rank, press = Words(tokenizer), table.value.rank, zstandard.ZstdCompressor(level=3)
    for whole in batches:
        for batch in slices(whole, _ROWS):
            codes = []
            for text in batch.column("text").to_pylist():
                found = words(text)
                code = np.fromiter(map(rank.get, found, repeat(0)), dtype="<u4", count=len(found)).view(np.uint8).reshape(-1, 4)
                codes.append([press.compress(code[:, byte].tobytes()) for byte in range(3)])
            columns = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict(columns | {"ranks": pa.array(codes, pa.list_(pa.binary()))})


def _assemble(batches: Iterator[pa.RecordBatch], table, kind: str) -> Iterator[pa.RecordBatch]:
    """Ranks and ids from elsewhere, joined by position."""
    known, press = table.value.ids, zstandard.ZstdDecompressor()
    for whole in batches:
        for batch in slices(whole, _ROWS):
            out = []
            rare = batch.column("rare")
            ends, positions, ids = rare.offsets.to_pylist(), rare.values.field("position"), rare.values.field("ids")
            for row, ranks in enumerate(batch.column("ranks").to_pylist()):
                code = sum(np.frombuffer(press.decompress(b), np.uint8).astype(np.uint32) << (8 * k) for k, b in enumerate(ranks))
                parts = list(map(known.__getitem__, code.tolist()))
                n = ends[row + 1] - ends[row]
                places = np.flatnonzero(code == 0).tolist()
                for i, found in zip(positions.slice(ends[row], n).to_pylist(), ids.slice(ends[row], n).to_pylist()):
                    parts[places[i]] = found
                out.append(np.frombuffer(b"".join(parts), kind).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])


def encode(documents: DataFrame, tokenizer: str, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, ids``: the token ids of each whole text, unsigned 32-bit little-endian.

    ``tokenizer`` is a byte-level BPE file of the tokenizers library. No special token is added; the tokenizer's special
    tokens are recognised inside texts.
    """
    joined, assemble = _joined(documents, tokenizer, frequent)
    return joined.mapInArrow(assemble, "doc_id long, ids binary")


def encode_and_decode(documents: DataFrame, tokenizer: str, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, ids, decoded``: ``encode`` and ``decode`` in one pass over the joined rows."""
    joined, assemble = _joined(documents, tokenizer, frequent)
    return joined.mapInArrow(partial(_both, assemble=assemble, tokenizer=tokenizer), "doc_id long, ids binary, decoded string")


def _both(batches: Iterator[pa.RecordBatch], assemble, tokenizer: str) -> Iterator[pa.RecordBatch]:
    return _decode(assemble(batches), tokenizer)


def _joined(documents: DataFrame, tokenizer: str, frequent: int) -> tuple[DataFrame, Callable]:
    """Rows of ranks beside the ids that came back, and the function that assembles them."""
    context = documents.sparkSession.sparkContext
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = context.broadcast(_frequent(texts.select("text"), tokenizer, frequent))
    keyed = _keyed(texts)
    # Of the rows of one hashed key one sends its words; every copy joins what comes back.
    own, shared = (keyed.where(x).select("key", "hashed", "text") for x in ("not hashed", "hashed"))
    rare = own.unionByName(shared.distinct()).mapInArrow(partial(_rare, tokenizer=tokenizer, table=table), f"{_KEY}, position int, word string")
    # In order of words before the shuffle too: neighbours in its blocks are alike and compress.
    runs = rare.sortWithinPartitions("word").repartition("word").sortWithinPartitions("word")
    encoded = runs.mapInArrow(partial(_encode_runs, tokenizer=tokenizer), f"{_KEY}, position int, ids binary")
    by_text = encoded.repartition("key", "hashed").groupBy("key", "hashed").agg(F.collect_list(F.struct("position", "ids")).alias("rare"))
    ranked = keyed.mapInArrow(partial(_ranked, tokenizer=tokenizer, table=table), f"{_KEY}, doc_id long, ranks array<binary>")
    none = F.array().cast("array<struct<position:int,ids:binary>>")
    joined = ranked.join(by_text, ["key", "hashed"], "left").select("doc_id", "ranks", F.coalesce("rare", none).alias("rare"))
    return joined, partial(_assemble, table=table, kind=id_type(tokenizer))


def _keyed(texts: DataFrame) -> DataFrame:
    """``key, hashed, doc_id, text``: the id is the key, or the text's hash where ids repeat or are missing."""
    repeated = staged(texts.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        hashed = F.col("doc_id").isNull()
        rows = texts
    else:
        rows = texts.join(repeated.withColumn("again", F.lit(True)), "doc_id", "left")
        hashed = F.col("doc_id").isNull() | F.col("again").isNotNull()
    return rows.select(F.when(hashed, F.xxhash64("text")).otherwise(F.col("doc_id")).alias("key"), hashed.alias("hashed"), "doc_id", "text")


@lru_cache(maxsize=2)
def pieces(tokenizer: str) -> list[bytes]:
    """The bytes of every id. Printable characters stand for their own byte, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    found = encoder(tokenizer).tokenizer
    special = {i: t.content.encode() for i, t in found.get_added_tokens_decoder().items()}
    out = [b""] * (max(found.get_vocab(True).values()) + 1)
    for piece, i in found.get_vocab(True).items():
        out[i] = special.get(i) or bytes(byte_of[c] for c in piece)
    return out


def _decode(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    piece = pieces(tokenizer)
    for whole in batches:
        for batch in slices(whole, _ROWS):
            texts = []
            for ids in batch.column("ids").to_pylist():
                data = b"".join(map(piece.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                texts.append(data.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (a column ``ids``) with ``decoded``, the text of the ids; special tokens are kept."""
    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in encoded.dtypes), "decoded string"])
    return encoded.mapInArrow(partial(_decode, tokenizer=tokenizer), schema)
