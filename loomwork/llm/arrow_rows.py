"""Small helpers for functions that run inside ``mapInArrow`` tasks, and for rows that pass through them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column that holds the rest of a row while a step works on its text.
REST = "_rest"


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces, so that what a step derives from them stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a path without a scheme is a mounted folder."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def apart(documents: DataFrame) -> DataFrame:
    """``text`` beside one column with all others, so that no name of theirs can clash with a step's own."""
    others = [c for c in documents.columns if c != "text"]
    return documents.select(F.struct(*others).alias(REST), F.col("text").cast("string").alias("text"))


def together(rows: DataFrame, like: DataFrame, text: Column | str = "text") -> DataFrame:
    """The columns of ``like`` again, with a new text."""
    new = F.col(text) if isinstance(text, str) else text
    return rows.select(*(new.alias(c) if c == "text" else F.col(REST).getField(c).alias(c) for c in like.columns))
