"""Nearest neighbours by multiprobe p-stable hashing, for the largest inner product.

Inner products become distances by one more component: every vector is brought to the largest norm M by a component
``sqrt(M^2 - |v|^2)``, every query is scaled to norm M and gets 0 there. Each of ``TABLES`` tables cuts space into cells by
``DIRECTIONS`` Gaussian projections. A query visits the cells of a table in the order of their estimated success, the
chance that a neighbour at the expected distance lies in them, until the visited cells reach the chance that makes the
tables together find ``TARGET`` of the neighbours. How many cells that takes depends on the distance only, not on the
number of vectors. Candidates of all tables merge, and their inner products are computed on the original vectors.

The expected distance comes from a sample of ``SAMPLE`` vectors with the smallest hash; all vectors are indexed. Cells are
held in chunks of at most about ``CHUNK`` vectors and queries in blocks of about ``QUERIES``; a chunk goes to each block
that visits its cell, and a task streams the chunks past one block. A query that finds fewer than it should is compared
with every chunk of one table.

Defined results: NULL vectors, zero vectors, those with NULL or non-finite components, with a norm that is not finite, or
of another length than most take no part, nor do rows without id; of repeated ids the best score counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.staging import staged

TABLES, DIRECTIONS = 4, 4
TARGET = 0.97
SAMPLE, CHUNK, QUERIES = 4096, 512, 1024
#: Tasks that share the chunks of a block of queries.
SHARES = 8
SEED = 9


class Index(NamedTuple):
    """Fitted parameters: projections ``TABLES x DIRECTIONS x (dimension + 1)``, shifts, cell width, norm, distance."""

    directions: np.ndarray
    shifts: np.ndarray
    width: float
    norm: float
    distance: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0))
        return np.hstack((vectors, rest[:, None]))

    def asked(self, queries: np.ndarray) -> np.ndarray:
        scaled = queries * (self.norm / np.linalg.norm(queries, axis=1))[:, None]
        return np.hstack((scaled, np.zeros((len(queries), 1))))

    def places(self, lifted: np.ndarray) -> np.ndarray:
        """Projections in units of cells: vector, table, direction."""
        return (np.einsum("nd,tkd->ntk", lifted, self.directions) + self.shifts) / self.width


def cell_keys(cells: np.ndarray) -> np.ndarray:
    """One number for table and cell, of ``... x table x direction`` whole coordinates."""
    key = np.broadcast_to(np.arange(1, cells.shape[-2] + 1, dtype=np.uint64), cells.shape[:-1]).copy()
    for k in range(cells.shape[-1]):
        key = (key ^ cells[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """Cumulative normal distribution by a logistic polynomial, good to 2e-4: it only orders cells."""
    return 1 / (1 + np.exp(-np.clip(1.5976 * x + 0.070566 * x**3, -700, 700)))


def probes(index: Index, query: np.ndarray) -> list[np.ndarray]:
    """For each table the keys of the cells to visit, by falling chance of success."""
    place = index.places(query[None])[0]
    spread = index.distance / index.width
    reach = int(np.ceil(3 * spread)) + 1
    steps = np.arange(-reach, reach + 1)
    enough = 1 - (1 - TARGET) ** (1 / len(place))
    out = []
    for table in range(len(place)):
        home = np.floor(place[table])
        edges = home[:, None] + np.append(steps, reach + 1)[None, :] - place[table][:, None]
        chance = np.diff(_normal_cdf(edges / spread), axis=1)
        joint = chance[0]
        for row in chance[1:]:
            joint = joint[..., None] * row
        order = np.argsort(-joint, axis=None, kind="stable")
        total = np.cumsum(joint.ravel()[order])
        chosen = np.unravel_index(order[: int(np.searchsorted(total, enough)) + 1], joint.shape)
        cells = np.stack([home[k] + steps[chosen[k]] for k in range(len(home))], axis=-1)
        keys = cell_keys(np.broadcast_to(cells[:, None, :], (len(cells), len(place), len(home))).astype(np.int64))
        out.append(keys[:, table])
    return out


def _clean(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = [], []
        for name, values in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
            if name is None or values is None or len(values) != length or None in values:
                continue
            vector = np.array(values, dtype="<f8")
            with np.errstate(over="ignore", invalid="ignore"):
                norm = vector @ vector
            if np.isfinite(norm) and norm > 0:
                ids.append(name)
                vectors.append(vector.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())], ["vec_id", "vector"])


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def _norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    largest, n = 0.0, 0
    for batch in batches:
        if batch.num_rows:
            largest = max(largest, float(np.linalg.norm(_matrix(batch.column("vector").to_pylist()), axis=1).max()))
            n += batch.num_rows
    yield pa.RecordBatch.from_arrays([pa.array([largest]), pa.array([n])], ["norm", "n"])


def fit(vectors: DataFrame, k: int) -> Index | None:
    """Projections, norm and expected distance of the k-th neighbour; None without vectors."""
    row = vectors.mapInArrow(_norms, "norm double, n long").agg(F.max("norm").alias("norm"), F.sum("n").alias("n")).first()
    if not row.n:
        return None
    sample = _matrix(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().column("vector").to_pylist())
    random = np.random.default_rng(SEED)
    directions = random.standard_normal((TABLES, DIRECTIONS, sample.shape[1] + 1))
    index = Index(directions, np.zeros((TABLES, DIRECTIONS)), 1.0, row.norm, 1.0)
    asked, lifted = index.asked(sample[:256]), index.lifted(sample)
    squares = (asked**2).sum(axis=1)[:, None] + (lifted**2).sum(axis=1)[None, :] - 2 * asked @ lifted.T
    np.fill_diagonal(squares, np.inf)
    rank = min(len(sample) - 1, max(1, round(k * len(sample) / row.n))) if len(sample) > 1 else 0
    nearest = np.sort(squares, axis=1)[:, rank - 1] if rank else np.array([row.norm**2])
    # Never so narrow that equal vectors alone would set the scale.
    distance = max(float(np.sqrt(max(0.0, np.quantile(nearest, 0.75)))), 0.1 * row.norm)
    shifts = random.random((TABLES, DIRECTIONS)) * distance
    return index._replace(shifts=shifts, width=distance, distance=distance)


def _place(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """A row for each vector and table."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = np.floor(index.places(index.lifted(_matrix(batch.column("vector").to_pylist()))))
        keys = cell_keys(cells.astype(np.int64))
        rows = np.repeat(np.arange(batch.num_rows), keys.shape[1])
        copied = batch.take(pa.array(rows))
        table = np.tile(np.arange(keys.shape[1]), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(table), pa.array(keys.ravel()), *copied.columns], ["table", "cell", "vec_id", "vector"])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows in order of ``keys``, by group."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != at:
                if held:
                    yield at, held
                at, held = key, []
            held.append(row)
    if held:
        yield at, held


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (cell, chunk), rows in _runs(batches, ["cell", "chunk"]):
        for start in range(0, len(rows), 2 * CHUNK):
            some = rows[start : start + 2 * CHUNK]
            ids = np.array([r["vec_id"] for r in some], "<i8").tobytes()
            data = b"".join(r["vector"] for r in some)
            yield pa.RecordBatch.from_pydict({"table": [some[0]["table"]], "cell": [cell], "chunk": [chunk], "ids": [ids], "vectors": [data]})


def chunks(vectors: DataFrame, index: Index) -> DataFrame:
    """``table, cell, chunk, ids, vectors``: all vectors in each table, by cell."""
    placed = staged(vectors.mapInArrow(partial(_place, index=index), "table long, cell long, vec_id long, vector binary"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).alias("parts"))
    dealt = placed.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("parts"))).drop("parts")
    dealt = dealt.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk")
    return staged(dealt.mapInArrow(_chunks, "table long, cell long, chunk long, ids binary, vectors binary"))


_ASKED = "block long, cell long, ids binary, vectors binary, positions binary"


def _ask(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """For each block of queries a row with the queries, and one for each cell with the positions of those that visit it."""
    for (block,), rows in _runs(batches, ["block"]):
        vectors = [r["vector"] for r in rows]
        visits: dict[int, list[int]] = {}
        for i, query in enumerate(index.asked(_matrix(vectors))):
            for cell in np.unique(np.concatenate(probes(index, query))).tolist():
                visits.setdefault(cell, []).append(i)
        ids = np.array([r["vec_id"] for r in rows], "<i8").tobytes()
        n = len(visits)
        yield pa.RecordBatch.from_pydict(
            {
                "block": [block] * (n + 1), "cell": [None, *visits], "ids": [ids, *[None] * n],
                "vectors": [b"".join(vectors), *[None] * n],
                "positions": [None, *(np.array(p, "<i4").tobytes() for p in visits.values())],
            },
            pa.schema([("block", pa.int64()), ("cell", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("positions", pa.binary())]),
        )


class _Best:
    """The k best candidates of each query of a block so far."""

    def __init__(self, ids: bytes, vectors: bytes, k: int):
        self.k, self.ids = k, np.frombuffer(ids, "<i8")
        self.queries = np.frombuffer(vectors, "<f8").reshape(len(self.ids), -1)
        self.least = np.full(len(self.ids), -np.inf)
        self.held: list[np.ndarray] = []
        self.n = 0

    def see(self, ids: np.ndarray, vectors: np.ndarray, positions: np.ndarray | None) -> None:
        at = np.arange(len(self.ids)) if positions is None else positions
        scores = self.queries[at] @ vectors.T
        slack = 1e-9 * (1 + np.abs(self.least[at]))
        q, v = np.nonzero((scores >= (self.least[at] - np.where(np.isfinite(slack), slack, 0))[:, None]) & (self.ids[at][:, None] != ids[None, :]))
        found = np.zeros(len(q), dtype=[("q", "<i8"), ("minus", "<f8"), ("id", "<i8")])
        found["q"], found["id"] = at[q], ids[v]
        # The same sum for a pair wherever it is met.
        found["minus"] = -(self.queries[found["q"]] * vectors[v]).sum(axis=1)
        self.held.append(found)
        self.n += len(found)
        if self.n > 50 * self.k * len(self.ids):
            self.cut()

    def cut(self) -> np.ndarray:
        rows = np.unique(np.concatenate(self.held)) if self.held else np.zeros(0, dtype=[("q", "<i8"), ("minus", "<f8"), ("id", "<i8")])
        rows = rows[np.sort(np.unique(rows[["q", "id"]], return_index=True)[1])]
        first = np.searchsorted(rows["q"], np.arange(len(self.ids) + 1))
        rows = rows[np.arange(len(rows)) - first[rows["q"]] < self.k]
        first = np.searchsorted(rows["q"], np.arange(len(self.ids) + 1))
        full = np.flatnonzero(np.diff(first) == self.k)
        self.least[full] = -rows["minus"][first[full + 1] - 1]
        self.held, self.n = [rows], len(rows)
        return rows

    def told(self) -> pa.RecordBatch:
        rows = self.cut()
        columns = [pa.array(self.ids[rows["q"]]), pa.array(rows["id"]), pa.array(-rows["minus"])]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows by block and share: the block's queries first (no positions in a row with ``queries``), then chunks."""
    best: _Best | None = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["is_block"]:
                if best:
                    yield best.told()
                best = _Best(row["ids"], row["vectors"], k)
            else:
                ids = np.frombuffer(row["ids"], "<i8")
                positions = None if row["positions"] is None else np.frombuffer(row["positions"], "<i4")
                best.see(ids, np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1), positions)
    if best:
        yield best.told()


def _found(blocks: DataFrame, visited: DataFrame, k: int) -> DataFrame:
    """Best candidates of blocks ``block, ids, vectors`` among ``block, positions, ids, vectors`` of the chunks they visit."""
    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long")))
    columns = ["block", "share", "is_block", "positions", "ids", "vectors"]
    queries = blocks.withColumns({"share": shares, "is_block": F.lit(True), "positions": F.lit(None).cast("binary")})
    visits = visited.withColumns({"share": F.pmod(F.xxhash64("cell", "chunk"), F.lit(SHARES)), "is_block": F.lit(False)})
    rows = queries.select(*columns).unionByName(visits.select(*columns))
    rows = rows.repartition("block", "share").sortWithinPartitions("block", "share", F.desc("is_block"))
    return rows.mapInArrow(partial(_search, k=k), "query_id long, vec_id long, score double")


def _blocks(queries: DataFrame, n: int) -> DataFrame:
    blocks = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // QUERIES))))
    return queries.withColumn("block", blocks).repartition("block").sortWithinPartitions("block", "vec_id")


def nearest(vectors: DataFrame, is_query: str, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best found for every row of ``vec_id, vector`` with ``is_query``.

    ``is_query`` is a SQL condition on ``vec_id``.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    lengths = given.where("vector is not null").groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    clean = staged(given.mapInArrow(partial(_clean, length=lengths.n if lengths else 0), "vec_id long, vector binary"))
    queries = clean.where(is_query).dropDuplicates(["vec_id"])
    index = fit(clean, k)
    if index is None:
        return clean.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    stored = chunks(clean, index)
    asked = staged(_blocks(queries, queries.count()).mapInArrow(partial(_ask, index=index), _ASKED))
    visited = asked.where("cell is not null").select("block", "cell", "positions").join(stored.drop("table"), "cell")
    found = staged(_found(asked.where("cell is null").select("block", "ids", "vectors"), visited, k).distinct())
    others = min(k, clean.select("vec_id").distinct().limit(k + 1).count() - 1)
    enough = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).where(F.col("n") >= others)
    left = queries.join(enough.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    remaining = left.count()
    if remaining and others:
        whole = _blocks(left, remaining).mapInArrow(_ask_all, "block long, ids binary, vectors binary")
        # Every block sees the chunks of one table, which hold every vector once; a chunk goes to each block by its number.
        blocks = max(1, -(-remaining // QUERIES))
        seen = stored.where(F.col("table") == 0).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        seen = seen.select("block", "cell", "chunk", F.lit(None).cast("binary").alias("positions"), "ids", "vectors")
        found = found.unionByName(_found(whole, seen, k))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _ask_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (block,), rows in _runs(batches, ["block"]):
        ids = np.array([r["vec_id"] for r in rows], "<i8").tobytes()
        yield pa.RecordBatch.from_pydict({"block": [block], "ids": [ids], "vectors": [b"".join(r["vector"] for r in rows)]})
