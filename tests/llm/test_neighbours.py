from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.llm import neighbours

KINDS = "vec_id long, vector array<double>, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0.0) for i, v in rows], KINDS)


def searched(df, condition, k):
    out = {}
    for r in neighbours.nearest(df, condition, k).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def brute_force(rows, queries, k):
    out = {}
    for q in queries:
        scores = [(-float((rows[q] * v).sum()), i) for i, v in rows.items() if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("kind", ["unit", "lengths", "clusters"])
def test_recall(spark, kind):
    rng = np.random.default_rng(len(kind))
    vectors = rng.standard_normal((3000, 16))
    if kind == "unit":
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if kind == "lengths":
        vectors *= rng.uniform(0.1, 5, 3000)[:, None]
    if kind == "clusters":
        vectors = vectors[rng.integers(0, 20, 3000)] + 0.05 * rng.standard_normal((3000, 16))
    rows = dict(enumerate(vectors))
    got = searched(frame(spark, rows.items()).repartition(5), "vec_id % 50 = 0", 10)
    want = brute_force(rows, range(0, 3000, 50), 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, score in found:
            assert score == pytest.approx(float((rows[q] * rows[i]).sum()), abs=1e-12)


def test_few_vectors_are_all_found_and_bad_ones_left_out(spark):
    rows = [(1, [1, 0, 0]), (2, [0.5, 0.5, 0]), (3, [-9, 0, 0]), (4, None), (5, [0, 0, 0]), (6, [1, None, 0]), (7, [float("nan"), 1, 0]),
            (8, [float("inf"), 0, 0]), (9, [1, 2]), (10, []), (None, [1, 1, 1]), (11, [1e200, 0, 0]), (12, [0, 0, 2])]
    got = searched(frame(spark, rows), "vec_id >= 1", 20)
    good = {i: np.array(v, float) for i, v in rows if i in (1, 2, 3, 12)}
    assert got == brute_force(good, good, 20)


def test_ties_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 16)
    same = [(i, [1.0, 2.0]) for i in range(200)]
    got = searched(frame(spark, [*same, (500, [3.0, 0.1]), (0, [1.0, 2.0])]), "vec_id in (0, 100)", 5)
    assert got == {0: [(i, 5.0) for i in range(1, 6)], 100: [(i, 5.0) for i in range(5)]}


def test_queries_that_find_too_few_see_every_vector_once(spark, monkeypatch):
    """In several blocks, by block number and not by one key for all."""
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    rng = np.random.default_rng(3)
    rows = dict(enumerate(rng.standard_normal((400, 12))))
    asked, found = [], neighbours._found
    monkeypatch.setattr(neighbours, "_found", lambda *a: asked.append(a) or found(*a))
    got = searched(frame(spark, rows.items()), "vec_id % 4 = 0", 399)
    want = brute_force(rows, range(0, 400, 4), 399)
    whole, seen, _ = asked[1]
    left = np.concatenate([np.frombuffer(r.ids, "<i8") for r in whole.collect()]).tolist()
    assert len(left) > 8 and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in left)
    n = {r.block: r.n for r in seen.groupBy("block").agg(F.sum(F.octet_length("ids") / 8).alias("n")).collect()}
    assert len(n) > 1 and set(n.values()) == {400}


def test_empty(spark):
    assert neighbours.nearest(frame(spark, []), "vec_id % 2 = 0", 3).collect() == []
    assert neighbours.nearest(frame(spark, [(1, [1, 1]), (3, [1, 0])]), "vec_id % 2 = 0", 3).collect() == []
    assert neighbours.nearest(frame(spark, [(2, [1, 1])]), "vec_id % 2 = 0", 3).collect() == []
    assert neighbours.nearest(frame(spark, [(2, [0, 0]), (4, None)]), "vec_id % 2 = 0", 3).collect() == []


def test_probes_are_in_order_of_success():
    rng = np.random.default_rng(0)
    directions = rng.standard_normal((neighbours.TABLES, neighbours.DIRECTIONS, 9))
    index = neighbours.Index(directions, rng.random((neighbours.TABLES, neighbours.DIRECTIONS)), 1.0, 1.0, 1.0)
    query = np.append(rng.standard_normal(8), 0.0)
    home = neighbours.cell_keys(np.floor(index.places(query[None]))[0].astype(np.int64))
    for table, keys in enumerate(neighbours.probes(index, query)):
        assert len(set(keys.tolist())) == len(keys) and home[table] in keys[: 3**neighbours.DIRECTIONS]
    far = neighbours.probes(index._replace(distance=2.0), query)
    assert len(far[0]) > len(neighbours.probes(index, query)[0])
