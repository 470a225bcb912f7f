"""K-means on weighted integer points ``(x, y, w)`` with truncating means.

Rounds keep a distance to the nearest and to the second nearest centroid for every point, as they were at some earlier round.
Since then a centroid has moved by a known distance, so the nearest is at most that much further away and the others are
at most the largest such distance nearer. Where this leaves no doubt a round takes the cluster as it is, and only for the
other points looks at every centroid: the result is the same, tie by tie. The distances are not carried from round to
round: they are renewed, in a table of their own, when too many points are in doubt.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.geometry import centroid_array, nearest, squared_distance

Centroid = tuple[int, int]


#: Share of the points in doubt above which distances are renewed, and what rounding may cost.
DOUBT = 0.3
_ROUNDING = 1e-9


class Round(NamedTuple):
    """``skipped`` is the share of the points whose cluster was known without looking at every centroid."""

    centroids: list[Centroid]
    shift: float
    skipped: float = 0.0


class Anchor(NamedTuple):
    """Points with their ``cluster``, the distance ``upper`` to its centroid and ``lower`` to the next, at these centroids."""

    points: DataFrame
    centroids: list[Centroid]


def draw_centroids(weighted: DataFrame, k: int, seed: int) -> DataFrame:
    """``k`` seeded draws with replacement, uniform over the rows behind the weights: ``(cluster, cx, cy)``.

    Every draw is a race: a point of weight w finishes after an exponential time of rate w, the first one is drawn, so
    its chance is w over the sum of all weights. The times come from a hash of seed, draw and point, so the result does
    not depend on partitioning. Each task hash-aggregates to one candidate per draw.
    """
    digest = F.md5(F.concat_ws("#", F.lit(seed), "cluster", "x", "y"))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    finish = -F.log(uniform) / F.col("w")
    raced = weighted.withColumn("cluster", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn("finish", finish)
    return raced.groupBy("cluster").agg(F.min_by("x", "finish").alias("cx"), F.min_by("y", "finish").alias("cy"))


def centroid_list(centroids: DataFrame) -> list[Centroid]:
    """The k centroids on the driver, by cluster number."""
    rows = centroids.select("cluster", "cx", "cy").collect()
    return [(row.cx, row.cy) for row in sorted(rows, key=lambda row: row.cluster)]


def centroid_rows(spark: SparkSession, centroids: Sequence[Centroid]) -> DataFrame:
    rows = [(i, cx, cy) for i, (cx, cy) in enumerate(centroids)]
    return spark.createDataFrame(rows, "cluster int, cx bigint, cy bigint")


def assigned(weighted: DataFrame, centroids: Sequence[Centroid]) -> DataFrame:
    """Add ``cluster``, the index of the nearest centroid."""
    return weighted.withColumn("cluster", nearest(F.col("x"), F.col("y"), centroids))


def cluster_means(weighted: DataFrame, centroids: Sequence[Centroid]) -> DataFrame:
    """``(cluster, cx, cy, size)`` of the non-empty clusters, means truncated towards zero.

    Tasks send on one partial sum per cluster, never the points.
    """
    cluster = nearest(F.col("x"), F.col("y"), centroids).alias("cluster")
    return weighted.groupBy(cluster).agg(
        F.expr("sum(x * w) div sum(w)").alias("cx"),
        F.expr("sum(y * w) div sum(w)").alias("cy"),
        F.sum("w").alias("size"),
    )


def one_round(weighted: DataFrame, centroids: Sequence[Centroid]) -> Round:
    """Move every centroid to the mean of its points; a centroid without points stays."""
    moved = list(centroids)
    for row in cluster_means(weighted, centroids).collect():
        moved[row.cluster] = (row.cx, row.cy)
    return Round(moved, _shift(centroids, moved))


def _shift(before: Sequence[Centroid], after: Sequence[Centroid]) -> float:
    """Sum of the squared distances that the centroids moved."""
    shift = 0.0
    for (x1, y1), (x2, y2) in zip(before, after):
        shift += float(x1 - x2) * (x1 - x2) + float(y1 - y2) * (y1 - y2)
    return shift


def anchored(weighted: DataFrame, centroids: Sequence[Centroid]) -> Anchor:
    """Look at every centroid for every point."""
    far = F.transform(centroid_array(centroids), lambda c: F.sqrt(squared_distance(F.col("x"), F.col("y"), c["cx"], c["cy"])))
    points = assigned(weighted, centroids).withColumn("far", F.array_sort(far)).select(
        "x", "y", "w", "cluster", F.get("far", F.lit(0)).alias("upper"), F.coalesce(F.get("far", F.lit(1)), F.lit(float("inf"))).alias("lower")
    )
    return Anchor(points, list(centroids))


def bounded_round(anchor: Anchor, centroids: Sequence[Centroid]) -> Round:
    """``one_round`` from earlier distances."""
    moves = [math.dist(a, b) for a, b in zip(anchor.centroids, centroids)]
    others = [max((m for j, m in enumerate(moves) if j != i), default=0.0) for i in range(len(moves))]
    told = F.from_json(F.lit(json.dumps([{"own": a, "other": b} for a, b in zip(moves, others)])), "array<struct<own: double, other: double>>")
    move = F.get(told, F.col("cluster"))
    upper, lower = F.col("upper") + move["own"], F.col("lower") - move["other"]
    sure = F.coalesce(upper * (1 + _ROUNDING) + _ROUNDING < lower * (1 - _ROUNDING), F.lit(False))
    rows = anchor.points.withColumn("sure", sure)
    cluster = F.when(F.col("sure"), F.col("cluster")).otherwise(nearest(F.col("x"), F.col("y"), centroids)).alias("cluster")
    means = rows.groupBy(cluster).agg(
        F.expr("sum(x * w) div sum(w)").alias("cx"), F.expr("sum(y * w) div sum(w)").alias("cy"),
        F.count("*").alias("points"), F.count_if("sure").alias("sure"),
    ).collect()
    moved = list(centroids)
    for row in means:
        moved[row.cluster] = (row.cx, row.cy)
    points = sum(row.points for row in means)
    return Round(moved, _shift(centroids, moved), sum(row.sure for row in means) / points if points else 1.0)


def bounded_rounds(weighted: DataFrame, centroids: Sequence[Centroid], eta: float, max_iter: int, doubt: float = DOUBT) -> Iterator[Round]:
    """``rounds``, most points skipped. Renewed distances are kept by Spark until the next renewal: what made them is one
    pass over ``weighted``, so a lost executor costs that pass."""
    current = list(centroids)
    if not current:
        return
    anchor = anchored(weighted, current)
    anchor.points.persist()
    try:
        for _ in range(max_iter + 1):
            done = bounded_round(anchor, current)
            yield done
            if done.shift < eta:
                return
            current = done.centroids
            if 1 - done.skipped > doubt:
                anchor.points.unpersist()
                anchor = anchored(weighted, current)
                anchor.points.persist()
    finally:
        anchor.points.unpersist()


def rounds(weighted: DataFrame, centroids: Sequence[Centroid], eta: float, max_iter: int) -> Iterator[Round]:
    """Rounds up to and including the first whose total squared shift is below ``eta``, at most ``max_iter + 1``."""
    current = list(centroids)
    if not current:
        return
    for _ in range(max_iter + 1):
        done = one_round(weighted, current)
        yield done
        if done.shift < eta:
            return
        current = done.centroids
