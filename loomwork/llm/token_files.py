"""Token ids in binary files of fixed-width packed blocks.

``write`` deals documents by range of ``doc_id``, encodes them and writes one or more files for each range; ``read``
gives every document's ids back with its place in the whole sequence; ``read_ids`` reads any stretch of one file.

A file (all numbers little-endian):

    magic           8 bytes, ``LOOMTOK1``
    bits            uint32, bits of an id: the fewest that hold the largest id of the vocabulary
    block           uint32, ids in a block
    documents, ids, blocks      uint64 each
    doc_id          int64 for each document, ascending
    has doc_id      uint8 for each document, 0 where it is NULL (which come first)
    starts          uint64 for each document and one more: index of its first id in the file
    block offsets   uint64 for each block and one more: its first byte after this table
    blocks          ids packed without gaps, lowest bit first; each block starts on a byte

A document lies whole in one file, so a file is as long as ``FILE_IDS`` ids and one document at most. A file is written
under another name and renamed when it is whole, and its name depends only on its range, so a task that runs again after
its executor was lost replaces it.

Defined results: a NULL or empty text is the end id alone; documents of one id follow each other by the hash of their
texts; documents without an id come first. ``write`` returns one row per file, which says where it starts in the whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.llm.arrow_rows import place, slices, utf8
from loomwork.llm.tokenizing import encoder, word_end_words
from loomwork.staging import staged

MAGIC, HEADER = b"LOOMTOK1", struct.Struct("<8sIIQQQ")
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 23
_ROWS = 250


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` one after the other in ``bits`` bits each, lowest first."""
    each = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(each, axis=1, bitorder="little", count=bits), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """``n`` ids from the one at ``first``: the bytes an id can touch, shifted and masked."""
    at = np.arange(first, first + n, dtype=np.int64) * bits
    padded = np.frombuffer(data + b"\0" * 5, dtype=np.uint8)
    value = np.zeros(n, dtype=np.uint64)
    for k in range((bits + 14) // 8):
        value |= padded[(at >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
    return ((value >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype("<u4")


def file_bytes(documents: list[tuple[int | None, np.ndarray]], bits: int) -> bytes:
    names = np.array([0 if name is None else name for name, _ in documents], dtype="<i8")
    present = np.array([name is not None for name, _ in documents], dtype=np.uint8)
    ids = np.concatenate([np.zeros(0, "<u4"), *(x for _, x in documents)])
    starts = np.cumsum([0, *(len(x) for _, x in documents)]).astype("<u8")
    blocks = [pack(ids[i : i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    head = HEADER.pack(MAGIC, bits, BLOCK_IDS, len(documents), len(ids), len(blocks))
    return b"".join([head, names.tobytes(), present.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """A file opened for reading: its tables, and ids of any stretch from only the blocks that hold them."""

    def __init__(self, uri: str):
        system, path = place(uri)
        self.file = system.open_input_file(path)
        magic, self.bits, self.block, documents, self.n, blocks = HEADER.unpack(self.file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        names, present = (np.frombuffer(self.file.read(documents * size), kind) for size, kind in ((8, "<i8"), (1, "u1")))
        self.doc_ids = [name if there else None for name, there in zip(names.tolist(), present.tolist())]
        self.starts = np.frombuffer(self.file.read(8 * documents + 8), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self.file.read(8 * blocks + 8), "<u8").astype(np.int64)
        self.data_at = self.file.tell()

    def ids(self, start: int, n: int) -> np.ndarray:
        if n <= 0:
            return np.zeros(0, "<u4")
        parts = []
        for block in range(start // self.block, (start + n - 1) // self.block + 1):
            begin, end = max(start - block * self.block, 0), min(start + n - block * self.block, self.block)
            self.file.seek(self.data_at + int(self.offsets[block]))
            data = self.file.read(int(self.offsets[block + 1] - self.offsets[block]))
            parts.append(unpack(data, self.bits, begin, end - begin))
        return np.concatenate(parts)


def read_ids(uri: str, start: int, n: int) -> np.ndarray:
    """``n`` ids of a file from the one at ``start``."""
    return TokenFile(uri).ids(start, n)


def _write_files(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int, bits: int):
    system, base = place(folder)
    task, part = TaskContext.get(), 0
    held: list[tuple[int | None, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        name = f"{base}/tokens-{task.partitionId():06d}-{part:06d}.bin"
        with system.open_output_stream(f"{name}.{task.taskAttemptId()}.part") as out:
            out.write(file_bytes(held, bits))
        system.move(f"{name}.{task.taskAttemptId()}.part", name)
        uri = f"{folder}/{name.rpartition('/')[2]}"
        return pa.RecordBatch.from_pylist(
            [{"range": task.partitionId(), "part": part, "path": uri, "documents": len(held), "n_ids": size}],
            pa.schema([("range", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("n_ids", pa.int64())]),
        )

    system.create_dir(base, recursive=True)
    end = np.array([end_id], "<u4").tobytes()
    for whole in batches:
        for batch in slices(whole, _ROWS):
            texts = [word_end_words(text) for text in utf8(batch, "text")]
            known = encoder(tokenizer).learn(set().union(*texts))
            for name, words in zip(batch.column("doc_id").to_pylist(), texts):
                ids = np.frombuffer(b"".join([*map(known.__getitem__, words), end]), "<u4")
                held.append((name, ids))
                size += len(ids)
                if size >= FILE_IDS:
                    yield flush()
                    held, size, part = [], 0, part + 1
    if held:
        yield flush()


def write(documents: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int) -> DataFrame:
    """Encode every text, end it with ``end_id`` and write the files; one row per file in order.

    ``tokenizer`` is a file of the tokenizers library that lower-cases, drops white space and parts letters from
    punctuation. Columns: ``range, part, path, documents, n_ids, start`` (ids of all files before).
    """
    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    job = partial(_write_files, folder=folder, tokenizer=tokenizer, end_id=end_id, bits=bits_for(vocabulary))
    files = staged(ordered.mapInArrow(job, "range int, part int, path string, documents long, n_ids long"))
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            file = TokenFile(path)
            for first in range(0, len(file.doc_ids), _ROWS):
                last = min(first + _ROWS, len(file.doc_ids))
                at = file.starts[first : last + 1]
                ids = file.ids(int(at[0]), int(at[-1] - at[0])).tobytes()
                texts = [ids[4 * (a - at[0]) : 4 * (b - at[0])] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(file.doc_ids[first:last], pa.int64()),
                    "start": pa.array(at[:-1] + start, pa.int64()),
                    "ids": pa.array(texts, pa.binary()),
                })


def read(files: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` (unsigned 32-bit little-endian) of every document in the files that ``write`` names."""
    spread = files.select("path", "start").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(_read_files, "doc_id long, start long, ids binary")

