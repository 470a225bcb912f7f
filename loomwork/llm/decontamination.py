"""Benchmark decontamination with a generalised suffix automaton of the test items.

The normalised items (A-Z lower-cased, words of digits, letters and non-ASCII) form one suffix automaton over word ids,
shared by all items. Each document streams its words through it and the longest match ending at each word is tracked.
Where it reaches the window length, the last words of the match are a window of some item; items shorter than the window
count where they occur as a whole.

Only stretches of words whose neighbours are neighbours in some item enter the automaton; no window can lie outside them.

The automaton goes to the tasks as a broadcast of at most ``AUTOMATON_WORDS`` item words. Longer benchmarks are dealt
into blocks of that size (long items in overlapping pieces), one pass over the documents each, with the marks of a pass
carried on in the rows.

Defined results: a NULL or empty text has no words; an item without words is ignored; an item without an id marks words
but is not listed; items with one id count once; repeated documents are judged row by row; an empty benchmark marks
nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.arrow_rows import REST, apart, slices, together, utf8
from loomwork.staging import discard, staged

WINDOW = 10
#: Item words in one automaton, and in one piece of a long item.
AUTOMATON_WORDS = 100_000
PIECE_WORDS = 20_000
#: Share of hit words beyond which a document goes as a whole.
MAX_COVERAGE = 0.5

_WORD_BYTES = bytes(
    (c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_NEIGHBOUR_BITS = 22


def normalised_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; every byte outside a word is a separator."""
    return text.translate(_WORD_BYTES).split() if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items each window-long match belongs to."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        sequences = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items]
        sequences = [(name, words) for name, words in sequences if words]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in sequences:
            self._add(words)
        self._label(sequences)
        self.shortest = min((min(len(words), window) for _, words in sequences), default=window)
        pairs = [w for _, words in sequences for w in zip(words, words[1:])]
        first, second = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        self.neighbours = np.zeros(1 << _NEIGHBOUR_BITS, dtype=bool)
        self.neighbours[self._slot(first, second)] = True

    @staticmethod
    def _slot(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return (first * 1_000_003 + second) & ((1 << _NEIGHBOUR_BITS) - 1)

    def _state(self, length: int, link: int, transitions: dict[int, int]) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, source: int, word: int, target: int) -> int:
        """The state for the string of ``source`` and ``word``, taken out of ``target`` where that holds longer ones."""
        if self.length[target] == self.length[source] + 1:
            return target
        part = self._state(self.length[source] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = part
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = part
            source = self.link[source]
        return part

    def _add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word, self.next[last][word])
                continue
            new, source = self._state(self.length[last] + 1, 0, {}), last
            while source >= 0 and word not in self.next[source]:
                self.next[source][word] = new
                source = self.link[source]
            if source >= 0:
                self.link[new] = self._split(source, word, self.next[source][word])
            last = new

    def _label(self, sequences: list[tuple[int | None, list[int]]]) -> None:
        """``named``: items of the window that ends at a state; ``whole``: lengths and items of the short ones."""
        self.named: dict[int, set] = {}
        self.whole: dict[int, list[tuple[int, int | None]]] = {}
        for name, words in sequences:
            state, seen = 0, set()
            for word in words:
                state = self.next[state][word]
                at = state
                while at > 0 and self.length[at] >= self.window and at not in seen:
                    seen.add(at)
                    if self.length[self.link[at]] < self.window:
                        self.named.setdefault(at, set()).add(name)
                    at = self.link[at]
            if len(words) < self.window:
                self.whole.setdefault(state, []).append((len(words), name))
        self.home: list[int] = [0] * len(self.next)  # the state, or that among its suffixes, of its window-long suffix
        self.short: list[tuple] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.home[state] = state if self.length[up] < self.window else self.home[up]
            self.short[state] = (*self.short[up], *self.whole.get(state, ()))

    def matches(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """Which words lie in an occurrence of a window, and the items of the windows; None where there is no hit."""
        if len(words) < self.shortest:
            return None, set()
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        known = ids >= 0
        joined = known[:-1] & known[1:]
        joined &= self.neighbours[self._slot(ids[:-1], ids[1:])]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
        stretches = [(a, b + 1) for a, b in edges.reshape(-1, 2).tolist() if b - a + 1 >= self.shortest]
        if self.shortest == 1:  # a single word can be an item
            stretches = [(a, b) for a, b in np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0])))).reshape(-1, 2).tolist()]
        change, items = None, set()
        for begin, end in stretches:
            state, matched = 0, 0
            for i, word in enumerate(ids[begin:end].tolist(), begin):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    matched = self.length[state]
                if word not in self.next[state]:
                    continue
                state, matched = self.next[state][word], matched + 1
                hit = 0
                if matched >= self.window:
                    hit = self.window
                    items |= self.named[self.home[state]]
                for length, name in self.short[state]:
                    if length <= matched:
                        hit = max(hit, length)
                        items.add(name)
                if hit:
                    if change is None:
                        change = np.zeros(len(words) + 1, dtype=np.int64)
                    change[i - hit + 1] += 1
                    change[i + 1] -= 1
        return (None if change is None else np.cumsum(change[:-1]) > 0), items


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Items as normalised text in pieces that overlap by all but one word of a window."""
    for batch in batches:
        names, texts = [], []
        for name, text in zip(batch.column("item_id").to_pylist(), utf8(batch, "text")):
            words = normalised_words(text)
            for start in range(0, max(len(words) - window + 1, min(len(words), 1)), PIECE_WORDS):
                names.append(name)
                texts.append(b" ".join(words[start : start + PIECE_WORDS + window - 1]))
        sizes = [text.count(b" ") + 1 for text in texts]
        yield pa.RecordBatch.from_pydict(
            {"item_id": names, "words": texts, "n": sizes},
            schema=pa.schema([("item_id", pa.int64()), ("words", pa.binary()), ("n", pa.int64())]),
        )


def _automata(benchmark: DataFrame, window: int, limit: int) -> Iterator[tuple[ItemAutomaton, bool]]:
    """One automaton for each block of items, built from a bounded number of words, and whether it is the last."""
    pieces = staged(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(partial(_pieces, window=window), "item_id long, words binary, n long")
        .distinct()
    )
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // limit)
    for block in range(blocks):
        chosen = pieces.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        yield ItemAutomaton([(row.item_id, row.words.split()) for row in chosen.collect()], window), block + 1 == blocks
    discard(pieces)


def _mark(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Count words and add this automaton's hits and items to those of earlier passes."""
    automaton = shared.value if shared else None
    for whole in batches:
        for batch in slices(whole, 1000):
            marked_rows: dict[str, list] = {"hits": [], "items": [], "n_words": [], "n_hit": []}
            for text, marks, names in zip(
                utf8(batch, "text"), batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            ):
                words = normalised_words(text)
                hit, found = automaton.matches(words) if automaton else (None, ())
                if hit is not None:
                    bits = np.packbits(hit)
                    marks = (bits if marks is None else bits | np.frombuffer(marks, np.uint8)).tobytes()
                    names = sorted({*(names or ()), *(x for x in found if x is not None)})
                n_hit = 0 if marks is None else int(np.bitwise_count(np.frombuffer(marks, np.uint8)).sum())
                for column, value in zip(marked_rows, (marks, names or [], len(words), n_hit)):
                    marked_rows[column].append(value)
            kinds = dict(zip(marked_rows, (pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64())))
            new = {c: pa.array(values, kinds[c]) for c, values in marked_rows.items()}
            kept = {c: batch.column(c) for c in batch.schema.names if c not in new}
            yield pa.RecordBatch.from_pydict(kept | new)


def marked(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = AUTOMATON_WORDS) -> DataFrame:
    """``documents`` with ``hits`` (a bit for each word, NULL without a hit), ``items``, ``n_words`` and ``n_hit``.

    Columns of ``documents`` with these four names are replaced.
    """
    rows, mark, schema = _before_last(documents, benchmark, window, limit)
    return rows.mapInArrow(mark, schema)


def _before_last(documents: DataFrame, benchmark: DataFrame, window: int, limit: int) -> tuple[DataFrame, Callable, str]:
    """Rows after all passes but the last, the function of that, and the schema it gives."""
    own = {"hits": "binary", "items": "array<long>", "n_words": "long", "n_hit": "long"}
    rows = documents.drop(*own).withColumns({c: F.lit(None).cast(own[c]) for c in ("hits", "items")})
    kept = [f"`{c}` {kind}" for c, kind in rows.dtypes if c not in own]
    schema = ", ".join([*kept, *(f"{c} {kind}" for c, kind in own.items())])
    context = documents.sparkSession.sparkContext
    for automaton, last in _automata(benchmark, window, limit):
        mark = partial(_mark, shared=context.broadcast(automaton))
        if last:
            return rows, mark, schema
        rows = staged(rows.mapInArrow(mark, schema))
    return rows, partial(_mark, shared=None), schema


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = AUTOMATON_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items`` (ids with an occurring window, sorted as strings)."""
    rows = marked(documents.select("doc_id", "text"), benchmark, window, limit)
    return rows.select(
        "doc_id", "n_words", "n_hit", F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items")
    )


def without_marked(text: bytes, hits: np.ndarray) -> bytes:
    """The text without its marked stretches of words, each cut from its first to its last word."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORD_BYTES))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hits.view(np.int8), [0])))).reshape(-1, 2).tolist()
    parts, at = [], 0
    for begin, end in edges:
        parts.append(text[at : places[begin][0]])
        at = places[end - 1][1]
    return b"".join([*parts, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch], mark, max_coverage: float) -> Iterator[pa.RecordBatch]:
    """Mark, leave out what is mostly hit, cut the rest."""
    for marked_batch in mark(batches):
        n_hit, n_words = (marked_batch.column(c).to_numpy() for c in ("n_hit", "n_words"))
        batch = marked_batch.filter(pa.array(n_hit <= max_coverage * n_words))
        texts = utf8(batch, "text")
        for i, (marks, n) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("n_words").to_pylist())):
            if marks is not None:
                texts[i] = without_marked(texts[i], np.unpackbits(np.frombuffer(marks, np.uint8))[:n].astype(bool))
        yield pa.RecordBatch.from_arrays([batch.column(REST), pa.array(texts, pa.binary()).cast(pa.string())], [REST, "text"])


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``documents`` with the same columns, benchmark passages cut out of their texts.

    A document of whose words more than ``max_coverage`` are hit goes as a whole. All others stay.
    """
    whole = apart(documents)
    rows, mark, _ = _before_last(whole, benchmark, window, AUTOMATON_WORDS)
    return together(rows.mapInArrow(partial(_cut, mark=mark, max_coverage=max_coverage), whole.schema), documents)
