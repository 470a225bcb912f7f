"""Near-duplicate documents by SuperMinHash.

A document's set holds the distinct shingles of five words. In its SuperMinHash every shingle ranks all signature
positions in an order of its own; a position's value is the best rank any shingle gives it, plus a random fraction. Ranks
are dealt level by level, and a document is done at the level where every position has a value, after one or two levels
for texts of some length.

1. Documents with equal sets are one class, named by its smallest ``doc_id``.
2. Signatures are cut into bands; classes that share a band meet in its bucket, where sketches of two bits for each
   position must agree as they do for similar sets. Of each part that holds together by
   sketches a bucket gives the edges to its smallest class, not pairs.
3. The components of these edges are clusters. Inside a cluster, pairs in order of their estimated similarity are
   confirmed on full sets until union-find has joined what can be joined.
4. The components of the confirmed links are the result.

Buckets and clusters of more than ``BLOCK`` classes are dealt into blocks, and every pair of blocks is a unit of its own:
all pairs are looked at, none is left out, and no task holds a whole group.

With 32 bands of 4 rows a pair of similarity 0.75 misses every bucket with a chance of 5e-6, and the sketch bound lies
five standard deviations under its mean.

Defined results: a document without words has an empty set and is linked with nothing; one of fewer than five words has
one shingle, all its words; a row without ``doc_id`` takes no part (component NULL, kept); repeated rows are each other's
copies. Rows of one ``doc_id`` with different texts count as one node in ``near_duplicates``. Deduplication looks at texts:
it keeps one row of each component of texts, that with the smallest ``doc_id`` and then the smallest hash of its text, and
of rows equal in ``doc_id`` and text one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.arrow_rows import utf8
from loomwork.llm.components import components
from loomwork.staging import staged

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
POSITIONS, ROWS = 128, 4
#: Of the 128 positions' two-bit sketches that must agree: 104 +- 4.4 do at a similarity of 0.75.
AGREEING = 82
BLOCK = 256
#: Bytes of text worked on at once.
_TOGETHER = 1 << 20
_PIECE = 1 << 18

_U = np.uint64
_random = np.random.default_rng(20240)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_TURN = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | _U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all bits of ``x``."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words between ``begin`` and ``end``, a stretch of ``_PIECE`` bytes and its last word at a time."""
    out = np.zeros(len(begin), np.uint64)
    cuts = np.searchsorted(begin, np.arange(0, len(data) + _PIECE, _PIECE)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        first, last = int(begin[a]), int(end[b - 1])
        n = 1 << max(_PIECE, last - first).bit_length()
        # Polynomial hash of each word out of running sums.
        terms = _BYTE[data[first:last]] * _powers(_BASE, n)[: last - first]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        out[a:b] = mixed((sums[end[a:b] - first] - sums[begin[a:b] - first]) * _powers(_BACK, n)[begin[a:b] - first])
    return out


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    data = np.frombuffer(b"\n".join([(t or b"").lower() for t in texts]) + b"\n", np.uint8)
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    begin, end = edges[0::2], edges[1::2]
    words = word_hashes(data, begin, end)
    bounds = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    first = np.searchsorted(begin, bounds)
    long = max(len(words) - SHINGLE + 1, 0)
    grams = np.zeros(long, np.uint64)
    for k in range(SHINGLE):
        grams += words[k : k + long] * _TURN[k]
    grams = mixed(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(mixed(np.array([(words[a:b] * _TURN[: b - a]).sum(dtype=np.uint64)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def super_min_hash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of non-empty sets, one row each: rank in the high half, fraction in the low half."""
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    best = np.full(len(sets) * POSITIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    low = _U(POSITIONS - 1)
    keys = mixed(elements + _U(_BASE))
    for level in range(POSITIONS):
        # The element's permutation of the positions: two affine steps with a shift between them.
        at = ((keys | _U(1)) * _U(level) + (keys >> _U(8))) & low
        at ^= at >> _U(4)
        at = (((keys >> _U(16)) | _U(1)) * at + (keys >> _U(24))) & low
        fraction = mixed(elements ^ _U((level + 1) * _BACK % (1 << 64))) >> _U(32)
        np.minimum.at(best, owner * POSITIONS + at.astype(np.int64), fraction | (_U(level) << _U(32)))
        open_ = (best.reshape(-1, POSITIONS) >> _U(32)).max(axis=1) > level
        if not open_.any():
            break
        still = open_[owner]
        elements, owner, keys = elements[still], owner[still], keys[still]
    return best.reshape(-1, POSITIONS)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    bands = signatures.reshape(-1, POSITIONS // ROWS, ROWS)
    keys = np.arange(bands.shape[1], dtype=np.uint64)[None, :] * _U(_BASE)
    for row in range(ROWS):
        keys = mixed(keys ^ bands[:, :, row]) + _U(_BASE)
    return keys.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Two bits of every position, as four 64-bit words a signature."""
    bits = (mixed(signatures) & _U(3)).astype(np.uint64).reshape(-1, POSITIONS // 32, 32)
    return (bits << (np.arange(32, dtype=np.uint64) * _U(2))).sum(axis=2, dtype=np.uint64)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions whose sketches agree, for each of ``a`` with each of ``b``."""
    differs = a[:, None, :] ^ b[None, :, :]
    differs = (differs | (differs >> _U(1))) & _U(0x5555555555555555)
    return POSITIONS - np.bitwise_count(differs).sum(axis=2, dtype=np.int64)


def _by_size(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= _TOGETHER:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_FEATURES = "doc_id long, print long, n_shingles long, f1 long, f2 long, bands array<long>, sketch binary"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch, "text")
        for a, b in _by_size(texts):
            sets = shingle_sets(texts[a:b])
            full = [s for s in sets if len(s)]
            prints = [[int(mixed(s ^ _U(seed)).sum(dtype=np.uint64).view(np.int64)) for seed in (_BASE, _BACK)] for s in sets]
            signed = super_min_hash(full) if full else np.zeros((0, POSITIONS), np.uint64)
            keys, sketch = iter(band_keys(signed).tolist()), iter(sketches(signed))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a), batch.column("print").slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                    pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    pa.array([next(sketch).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ],
                ["doc_id", "print", "n_shingles", "f1", "f2", "bands", "sketch"],
            )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows in order of ``keys`` as tables that end where a group ends, some groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changes = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            changes[1:] |= column[1:] != column[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns)):
            changes[0] = True
        last = int(np.flatnonzero(changes)[-1]) if changes.any() else 0
        if changes.any():
            done = [*held, batch.slice(0, last)]
            held = []
            yield pa.Table.from_batches([b for b in done if b.num_rows] or done[:1])
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    changes = np.ones(table.num_rows + 1, dtype=bool)
    changes[1:-1] = False
    for key in keys:
        column = table.column(key).to_numpy()
        changes[1:-1] |= column[1:] != column[:-1]
    return np.flatnonzero(changes)


def _parts(near: np.ndarray) -> list[tuple[int, int]]:
    """An edge from the first member of each connected part of a symmetric matrix of neighbours to every other."""
    unseen, edges = np.ones(len(near), dtype=bool), []
    for root in range(len(near)):
        queue = [root] if unseen[root] else []
        unseen[root] = False
        while queue:
            found = np.flatnonzero(near[queue.pop()] & unseen)
            unseen[found] = False
            edges += [(root, y) for y in found.tolist()]
            queue += found.tolist()
    return edges


_UNIT = ["unit", "i", "j"]
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compared(side: np.ndarray, i: int, j: int) -> np.ndarray | None:
    """Which pairs of members belong to this pair of blocks."""
    return side[:, None] != side[None, :] if i != j else None


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _groups(batches, _UNIT):
        reps, side = table.column("rep").to_numpy(), table.column("side").to_numpy()
        block_i, block_j = table.column("i").to_numpy(), table.column("j").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u8").reshape(-1, POSITIONS // 32)
        bounds, a, b = _bounds(table, _UNIT), [], []
        twos = bounds[:-1][(np.diff(bounds) == 2)]
        twos = twos[(block_i[twos] == block_j[twos]) | (side[twos] != side[twos + 1])]
        differs = sketch[twos] ^ sketch[twos + 1]
        differs = (differs | (differs >> _U(1))) & _U(0x5555555555555555)
        twos = twos[POSITIONS - np.bitwise_count(differs).sum(axis=1, dtype=np.int64) >= AGREEING]
        a += reps[twos].tolist()
        b += reps[twos + 1].tolist()
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if end - begin > 2:
                near = agreement(sketch[begin:end], sketch[begin:end]) >= AGREEING
                allowed = _compared(side[begin:end], block_i[begin], block_j[begin])
                for x, y in _parts(near if allowed is None else near & allowed):
                    a.append(int(reps[begin + x]))
                    b.append(int(reps[begin + y]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGES)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact rule on two sorted sets."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _confirmed(reps: list[int], sets: list[np.ndarray], sketch: np.ndarray, allowed: np.ndarray | None) -> list[tuple[int, int]]:
    """Links that hold on full sets, as many as join everything that they can join."""
    agree = agreement(sketch, sketch)
    candidates = np.triu(agree >= AGREEING, 1)
    if allowed is not None:
        candidates &= allowed
    x, y = np.nonzero(candidates)
    root, links = list(range(len(reps))), []

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for p in np.argsort(-agree[x, y], kind="stable").tolist():
        u, v = int(x[p]), int(y[p])
        if find(u) != find(v) and similar(sets[u], sets[v]):
            root[find(u)] = find(v)
            links.append((reps[u], reps[v]))
    return links


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _groups(batches, _UNIT):
        bounds = _bounds(table, _UNIT)
        links = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            unit = table.slice(begin, end - begin)
            texts = unit.column("text").cast(pa.large_binary()).to_pylist()
            sets = [s for a, b in _by_size(texts) for s in shingle_sets(texts[a:b])]
            sketch = np.frombuffer(b"".join(unit.column("sketch").to_pylist()), "<u8").reshape(-1, POSITIONS // 32)
            allowed = _compared(unit.column("side").to_numpy(), unit.column("i")[0].as_py(), unit.column("j")[0].as_py())
            links += _confirmed(unit.column("rep").to_pylist(), sets, sketch, allowed)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=_EDGES)


def _dealt(members: DataFrame, group: str) -> DataFrame:
    """Members of each group of two or more, in units of two blocks: ``unit, i, j, side`` and the members' columns."""
    sizes = members.groupBy(group).agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = members.join(sizes, group).withColumn("blocks", blocks)
    rows = rows.withColumn("side", F.pmod(F.xxhash64("rep", "print"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"unit": F.col(group), "i": F.least("side", "other"), "j": F.greatest("side", "other")})
    return rows.drop("size", "blocks", "other", group)


def _in_units(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "rep")


def _classified(documents: DataFrame) -> DataFrame:
    """``doc_id, print, n_shingles, first, part, component_id`` of every row: the smallest ``doc_id`` of its set, a number for
    the component of its set (NULL without one) and the smallest ``doc_id`` there (NULL where that is ``first``)."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("print", F.xxhash64("text"))
    features = staged(texts.mapInArrow(_features, _FEATURES))
    same = ["f1", "f2", "n_shingles"]
    linked = features.where("n_shingles > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "print")).alias("first")
    classes = linked.groupBy(*same).agg(first, F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    # Classes are numbered: ids do not tell them apart where an id has several texts.
    classes = classes.withColumns({"rep": F.monotonically_increasing_id(), "print": F.col("first.print"), "first": F.col("first.doc_id")})
    classes = staged(classes)
    banded = classes.select("rep", "print", "sketch", F.explode("bands").alias("band"))
    close = _in_units(_dealt(banded, "band")).mapInArrow(_bucket_edges, "a long, b long")
    clusters = components(close)
    members = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    # One row and one text for each class, so blocks are cut by the rows that arrive, however often a row is repeated.
    members = members.join(classes.select("rep", "first", "print", "sketch"), "rep")
    wanted = members.select("first", "print")
    found = texts.withColumnRenamed("doc_id", "first").join(wanted, ["first", "print"], "left_semi").distinct()
    with_text = _dealt(members, "cluster").join(found, ["first", "print"])
    links = _in_units(with_text).mapInArrow(_confirm, "a long, b long")
    joined = components(links).select(F.col("node").alias("rep"), "component").join(classes.select("rep", "first"), "rep")
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    smallest = joined.join(smallest, "component").select("rep", "component", "component_id")
    named = features.drop("bands", "sketch").join(classes.select(*same, "rep", "first"), same, "left").join(smallest, "rep", "left")
    takes_part = F.col("doc_id").isNotNull()
    part, first = (F.when(takes_part, x) for x in (F.coalesce("component", "rep"), F.col("first")))
    return named.select("doc_id", "print", "n_shingles", first.alias("first"), part.alias("part"), F.when(takes_part, F.col("component_id")).alias("component_id"))


def _by_id(found: DataFrame) -> DataFrame:
    """``found`` with one component for all texts of a ``doc_id``."""
    found = staged(found)
    several = found.where("part is not null").groupBy("doc_id").agg(F.min("part").alias("one"), F.max("part").alias("other")).where("one != other")
    several = staged(several.select("doc_id", "one"))
    if several.isEmpty():
        return found
    linked = components(found.join(several, "doc_id").where("part is not null").select("one", "part"))
    linked = linked.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    merged = found.join(linked, "part", "left")
    smallest = merged.where("whole is not null").groupBy("whole").agg(F.min(F.coalesce("component_id", "first")).alias("of_whole"))
    named = merged.join(smallest, "whole", "left").withColumn("component_id", F.coalesce("of_whole", "component_id"))
    return named.select(*found.columns)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    component: Column = F.coalesce("component_id", "first", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return _by_id(_classified(documents)).select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay: one of each component, all that are linked with nothing, of repeated rows one."""
    found = staged(_classified(documents).select("doc_id", "print", "part"))
    key = F.struct("doc_id", "print")
    stays = found.where("part is not null").groupBy("part").agg(F.min(key).alias("stays"))
    gone = found.join(stays, "part").where(key != F.col("stays")).select("doc_id", "print").distinct()
    # The rows travel as one column, so that no name of theirs can clash.
    rows = documents.select(
        F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("print")
    )
    # As many as a share of all documents: the same kind of join at every size.
    kept = rows.join(gone.hint("merge"), ["doc_id", "print"], "left_anti")
    repeated = staged(found.where("doc_id is not null").groupBy("doc_id", "print").count().where("count > 1").select("doc_id", "print"))
    if not repeated.isEmpty():
        single = kept.join(repeated, ["doc_id", "print"], "left_anti").select("row")
        copies = kept.join(repeated, ["doc_id", "print"]).groupBy("doc_id", "print")
        kept = single.unionByName(copies.agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row"))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in documents.columns))
