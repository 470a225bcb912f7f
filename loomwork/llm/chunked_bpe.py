"""Byte-level BPE by overlapping chunks.

A text that is longer than a chunk is cut into chunks that start every ``CHUNK`` code points and see ``OVERLAP`` more of what
follows, so one very long text is worked on by many tasks:

1. Every chunk is pre-tokenised from its own first character, as if the text began there.
2. Inside the overlap of two neighbours the first end of a pre-token that both have is where they resynchronise: the
   pattern looks only ahead, so from a common place on both cut alike. The chunk before is right up to there, the chunk
   after from there. Ends after white space do not count, since what the pattern makes of white space depends on the
   character after it, nor do those beside characters that versions of Unicode class differently.
3. Neighbours without such a place (one run of letters, say, longer than the overlap) become one chunk and are cut again,
   until every pair of neighbours resynchronises.
4. The pieces between these places hold whole pre-tokens. Each is encoded by itself, and the ids are joined in order.

A text of at most one chunk is its own only piece. Decoding concatenates the bytes of the ids.

Defined results: a NULL or empty text has no ids; every row is encoded for itself, whatever ids repeat or are NULL; only
``doc_id`` and ``text`` are read, so other columns cannot clash. No special token is added or recognised. A task holds a
whole text at most, or the chunks that one pre-token spans.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.llm.arrow_rows import slices
from loomwork.staging import staged

#: Code points.
CHUNK, OVERLAP = 1 << 14, 1 << 9
#: An alternative of the pattern may need this many code points after a match to be sure of it.
_AHEAD = 3
#: What is assigned in this old version of Unicode has kept its class since.
_SETTLED = unicodedata.ucd_3_2_0
_ROWS = 250


@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a file of ranks, once a process."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _counts(text: str, end: int) -> bool:
    """Whether neighbours may meet at this end: it is before a space or new line, or where characters of two settled
    classes touch, so every library that knows the pattern ends there."""
    if end == len(text):
        return not text[end - 1].isspace()
    last, after = text[end - 1], text[end]
    if last.isspace() or after in " \n":
        return not last.isspace()
    settled = "Cn" not in (_SETTLED.category(last), _SETTLED.category(after)) and not after.isspace()
    return settled and last != "'" and not (last.isalpha() and after.isalpha())


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Each text as chunks: where they begin, their own length, and their text with the overlap."""
    for batch in batches:
        for row, name, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
            begins = range(0, len(text), chunk)
            for some in (begins[i : i + _ROWS] for i in range(0, len(begins), _ROWS)):
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([row] * len(some), pa.int64()),
                    "doc_id": pa.array([name] * len(some), pa.int64()),
                    "begin": pa.array(some, pa.int64()),
                    "own": pa.array([min(chunk, len(text) - b) for b in some], pa.int64()),
                    "text": pa.array([text[b : b + chunk + overlap] for b in some], pa.string()),
                })


def _ends(batches: Iterator[pa.RecordBatch], pattern: str, overlap: int) -> Iterator[pa.RecordBatch]:
    """Pre-tokenise each chunk: the ends of pre-tokens in its first and in its last ``overlap`` code points, counted
    from the start of the chunk and from the start of its neighbour."""
    cut = regex.compile(pattern)
    for whole in batches:
        for batch in slices(whole, _ROWS):
            heads, tails = [], []
            for own, text in zip(batch.column("own").to_pylist(), batch.column("text").to_pylist()):
                sure = len(text) - _AHEAD if len(text) > own else len(text)
                ends = [m.end() for m in cut.finditer(text) if m.end() <= sure and (m.end() <= overlap or m.end() >= own)]
                ends = [e for e in ends if _counts(text, e)]
                heads.append([e for e in ends if e <= overlap])
                tails.append([e - own for e in ends if e >= own])
            columns = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "head", "tail"])


_CHUNK = "row long, doc_id long, begin long, own long, text string"


def _cut(chunks: DataFrame, pattern: str, overlap: int) -> DataFrame:
    """Chunks with ``head`` and ``tail``, the chunks of one text spread over the tasks."""
    job = partial(_ends, pattern=pattern, overlap=overlap)
    return staged(chunks.repartition("row", "begin").mapInArrow(job, f"{_CHUNK}, head array<long>, tail array<long>"), in_loop=True)


def _meeting(cut: DataFrame) -> DataFrame:
    """``row, begin, meet`` for every chunk but the first of a text: where it resynchronises with the chunk before,
    counted from its start, NULL if nowhere."""
    before = cut.select("row", (F.col("begin") + F.col("own")).alias("begin"), "tail")
    return staged(cut.select("row", "begin", "head").join(before, ["row", "begin"]).select(
        "row", "begin", F.array_min(F.array_intersect("head", "tail")).alias("meet")
    ), in_loop=True)


def _merged(chunks: DataFrame, meeting: DataFrame) -> DataFrame:
    """Chunks that do not meet the chunk before them become part of it."""
    apart = meeting.where("meet is null").select("row", "begin", F.lit(0).alias("starts"))
    order = Window.partitionBy("row").orderBy("begin")
    marks = chunks.select("row", "begin").join(apart, ["row", "begin"], "left")
    marks = marks.withColumn("island", F.sum(F.coalesce("starts", F.lit(1))).over(order)).drop("starts")
    joined = chunks.join(marks, ["row", "begin"]).groupBy("row", "doc_id", "island").agg(
        F.array_sort(F.collect_list(F.struct("begin", "own", "text"))).alias("parts"), F.sum("own").alias("own")
    )
    owns = F.transform("parts", lambda x: F.substring(x.text, F.lit(1), x.own.cast("int")))
    last = F.element_at("parts", -1)
    overlap = F.substring(last.text, (last.own + 1).cast("int"), F.length(last.text))
    text = F.concat(F.array_join(owns, ""), overlap)
    return joined.select("row", "doc_id", F.element_at("parts", 1).begin.alias("begin"), "own", text.alias("text"))


def pieces(long_texts: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``row, doc_id, begin, text``: the texts of ``row, doc_id, text`` in pieces that hold whole pre-tokens."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap is at least one code point and at most a chunk")
    chunks = long_texts.select("row", "doc_id", "text").mapInArrow(partial(_chunks, chunk=chunk, overlap=overlap), _CHUNK)
    cut = _cut(chunks, pattern, overlap)
    meeting = _meeting(cut)
    while not (apart := meeting.where("meet is null")).isEmpty():
        # Only texts with such a chunk are cut again.
        rows = apart.select("row").distinct()
        again = _cut(_merged(cut.join(rows, "row", "left_semi"), meeting.join(rows, "row", "left_semi")), pattern, overlap)
        cut = staged(cut.join(rows, "row", "left_anti").unionByName(again), in_loop=True)
        meeting = _meeting(cut)
    first = meeting.select("row", "begin", F.col("meet").alias("first"))
    after = meeting.select("row", F.col("begin").alias("next"), F.col("meet").alias("after"))
    chunks = cut.select("row", "doc_id", "begin", "own", "text", (F.col("begin") + F.col("own")).alias("next"))
    placed = chunks.join(first, ["row", "begin"], "left").join(after, ["row", "next"], "left")
    start, end = F.coalesce("first", F.lit(0)), F.col("own") + F.coalesce("after", F.lit(0))
    return placed.select("row", "doc_id", "begin", F.substring("text", (start + 1).cast("int"), (end - start).cast("int")).alias("text"))


class Coder(NamedTuple):
    """What tasks need for encoding and decoding."""

    ranks: str
    pattern: str

    def encode(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``ids`` in place of ``text``, other columns as they are."""
        encoder = encoding(*self)
        for whole in batches:
            for batch in slices(whole, _ROWS):
                ids = [np.array(encoder.encode_ordinary(text or ""), "<u4").tobytes() for text in batch.column("text").to_pylist()]
                columns = {c: batch.column(c) for c in batch.schema.names if c != "text"}
                yield pa.RecordBatch.from_pydict(columns | {"ids": pa.array(ids, pa.binary())})

    def decode(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = encoding(*self)
        for whole in batches:
            for batch in slices(whole, _ROWS):
                data = [decoder.decode_bytes(np.frombuffer(ids or b"", "<u4").tolist()) for ids in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, "decoded"])

    def narrow(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Encode pieces; their ids travel in as few bytes as the vocabulary needs."""
        for batch in self.encode(batches):
            ids = [np.frombuffer(x, "<u4").astype(self._kind()).tobytes() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("row", "doc_id", "begin")} | {"ids": pa.array(ids, pa.binary())})

    def _kind(self) -> str:
        return "<u2" if encoding(*self).n_vocab <= 1 << 16 else "<u4"

    def join(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids of the parts of each text, in order."""
        for whole in batches:
            for batch in slices(whole, _ROWS):
                ids = [b"".join(part["ids"] for part in parts) for parts in batch.column("parts").to_pylist()]
                ids = [np.frombuffer(x, self._kind()).astype("<u4").tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    def encode_and_decode(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return self.decode(self.encode(batches))

    def join_and_decode(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return self.decode(self.join(batches))


def _short_and_long(documents: DataFrame, coder: Coder, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text`` of texts of one chunk, and ``doc_id, parts`` of the others, whose parts are encoded."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    cut = pieces(texts.where(long).withColumn("row", F.monotonically_increasing_id()), coder.pattern, chunk, overlap)
    encoded = cut.mapInArrow(coder.narrow, "row long, doc_id long, begin long, ids binary")
    parts = encoded.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("begin", "ids"))).alias("parts"))
    return texts.where(~long), parts.select("doc_id", "parts")


def encode(documents: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids``: the token ids of each whole text, unsigned 32-bit little-endian.

    ``ranks`` is a file of a rank for each token's bytes, ``pattern`` cuts texts into the parts that merge apart; it may
    look ahead of a match, by one character at white space, but not behind it.
    """
    coder = Coder(ranks, pattern)
    short, parts = _short_and_long(documents, coder, chunk, overlap)
    schema = "doc_id long, ids binary"
    return short.mapInArrow(coder.encode, schema).unionByName(parts.mapInArrow(coder.join, schema))


def encode_and_decode(documents: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids, decoded``: ``encode`` and ``decode`` with one Python worker for each task."""
    coder = Coder(ranks, pattern)
    short, parts = _short_and_long(documents, coder, chunk, overlap)
    schema = "doc_id long, ids binary, decoded binary"
    return short.mapInArrow(coder.encode_and_decode, schema).unionByName(parts.mapInArrow(coder.join_and_decode, schema))


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` (a column ``ids``) with ``decoded``, the bytes of the ids one after the other."""
    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in encoded.dtypes), "decoded binary"])
    return encoded.mapInArrow(Coder(ranks, pattern).decode, schema)
