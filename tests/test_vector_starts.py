from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.operators import lloyd, vector_clusters


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    return rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector")).cache()


@pytest.mark.parametrize("k", [2, 8])
def test_starts_by_distance_cost_less(vectors, k):
    for seed in range(5):
        plain = vector_clusters.draw_centers(vectors, k, seed, F.col("vec_id"))
        drawn = vector_clusters.drawn_by_distance(vectors, k, seed, F.col("vec_id"))
        assert len(drawn) == k
        assert vector_clusters.cost(vectors, drawn) <= vector_clusters.cost(vectors, plain)


def test_candidates_weigh_all_rows(vectors):
    found = vector_clusters.candidates(vectors, 4, 3, F.col("vec_id"))
    assert sum(found.weights) == vectors.count() and found.drawn[0] == 0 and set(found.drawn) == {0, 1, 2}
    assert 4 <= len(found.vectors) <= 1 + 2 * 4 * 2 * 3


def test_few_different_vectors(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 5 + [([3.0, 4.0],)], "vector array<double>")
    assert sorted(map(tuple, vector_clusters.drawn_by_distance(same, 2, 1))) == [(1.0, 2.0), (3.0, 4.0)]
    assert len(vector_clusters.drawn_by_distance(same, 4, 1)) == 4
    assert vector_clusters.drawn_by_distance(same.where("false"), 2, 1) == []
    with pytest.raises(ValueError):
        vector_clusters.k_means(same, start="else")


def test_row_silhouettes_have_the_mean_of_the_whole(vectors):
    rows = vectors.withColumnRenamed("label", "predicted_cluster")
    scored = vector_clusters.silhouettes(rows).agg(F.avg("silhouette")).first()[0]
    assert scored == pytest.approx(vector_clusters.silhouette(rows), abs=1e-9)


def test_row_silhouettes_of_odd_rows(spark):
    rows = [([0.0], 0), ([2.0], 0), ([10.0], 1), (None, 1), ([1.0], None)]
    scored = vector_clusters.silhouettes(spark.createDataFrame(rows, "vector array<double>, predicted_cluster int"))
    assert [r.silhouette for r in scored.collect()] == [pytest.approx(1 - 4 / 100), pytest.approx(1 - 4 / 64), 0.0, None, None]
    one = vector_clusters.silhouettes(spark.createDataFrame(rows[:2], "vector array<double>, predicted_cluster int"))
    assert [r.silhouette for r in one.collect()] == [0.0, 0.0]


@pytest.mark.parametrize("doubt", [0.0, 0.3, 1.0])
def test_bounded_rounds_are_the_same_rounds(spark, doubt):
    deal = np.random.default_rng(2)
    points = [(int(c * 500 + x), int(y), int(w)) for c, x, y, w in zip(deal.integers(0, 6, 800), deal.normal(0, 90, 800), deal.normal(0, 90, 800), deal.integers(1, 4, 800))]
    weighted = spark.createDataFrame(points, "x bigint, y bigint, w bigint").cache()
    start = [(p[0], p[1]) for p in points[:11]] + [(points[0][0], points[0][1])]
    plain = list(lloyd.rounds(weighted, start, 2.0, 25))
    bounded = list(lloyd.bounded_rounds(weighted, start, 2.0, 25, doubt))
    assert [(r.centroids, r.shift) for r in bounded] == [(r.centroids, r.shift) for r in plain] and len(plain) > 5
    later = [r.skipped for r in bounded[len(bounded) // 2 :]]
    assert doubt == 1.0 or sum(later) / len(later) > 0.6


def test_bounds_keep_ties_with_the_lowest_index(spark):
    weighted = spark.createDataFrame([(0, 0, 1), (10, 0, 1), (5, 0, 1)], "x bigint, y bigint, w bigint")
    for centroids in ([(0, 0), (10, 0)], [(10, 0), (0, 0)], [(5, 5), (5, 5)], [(3, 3)]):
        for r, b in zip(lloyd.rounds(weighted, centroids, 0.5, 4), lloyd.bounded_rounds(weighted, centroids, 0.5, 4)):
            assert r.centroids == b.centroids
    assert list(lloyd.bounded_rounds(weighted, [], 1.0, 3)) == []
