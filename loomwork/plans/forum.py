"""Clusters of forum questions by domain and best answer score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.geometry import centroid_array
from loomwork.operators import lloyd, postings
from loomwork.operators.score_summary import score_summary
from loomwork.staging import spread, staged

# The domain list in its order, the distance between two domains on the x axis, the number of clusters,
# the total squared shift below which the clusters count as settled, and the number of rounds before the last one.
DOMAINS = [
    "Machine-Learning",
    "Compute-Science",
    "Algorithm",
    "Big-Data",
    "Data-Analysis",
    "Security",
    "Silicon Valley",
    "Computer-Systems",
    "Deep-learning",
    "Internet-Service-Providers",
    "Programming-Language",
    "Cloud-services",
    "Software-Engineering",
    "Embedded-System",
    "Architecture",
]
SPREAD = 50000
CLUSTERS = 45
ETA = 20.0
MAX_ITER = 120


def scored_questions(raw: DataFrame) -> DataFrame:
    """``(id, tags, score, best)`` of the answered questions."""
    return postings.scored_questions(raw)


def domain_points(raw: DataFrame, domains: Sequence[str] = DOMAINS, spread: int = SPREAD) -> DataFrame:
    """``(id, x, y)`` of the answered and tagged questions among the postings."""
    return postings.domain_points(raw, domains, spread)


def staged_points(points: DataFrame) -> DataFrame:
    """Points as ``(x, y, w)``, written once: draws, rounds and report all read them."""
    return staged(postings.weighted_points(points))


def sample_centroids(points: DataFrame, k: int = CLUSTERS, seed: int = 1) -> DataFrame:
    """``(cluster, cx, cy)``, see ``draw_centroids``. ``points`` may carry weights ``w``."""
    return lloyd.draw_centroids(_weighted(points), k, seed)


def lloyd_kmeans(
    points: DataFrame, centroids: DataFrame, eta: float = ETA, max_iter: int = MAX_ITER
) -> DataFrame:
    """Final ``(cluster, cx, cy)``. Each round is one small job over the cached points, most of which are settled by bounds on
    their distances; k rows come back."""
    weighted = spread(points if "w" in points.columns else staged_points(points)).persist()
    try:
        final = lloyd.centroid_list(centroids)
        for done in lloyd.bounded_rounds(weighted, final, eta, max_iter):
            final = done.centroids
    finally:
        weighted.unpersist()
    return lloyd.centroid_rows(points.sparkSession, final)


def cluster_report(
    points: DataFrame, centroids: DataFrame, domains: Sequence[str] = DOMAINS, spread: int = SPREAD
) -> DataFrame:
    """``(cluster, cx, cy, domain, size, median, avg)`` of the non-empty clusters, lowest average first.

    The domain is NULL where the centroid lies left of the first one.
    """
    final = lloyd.centroid_list(centroids)
    located = staged(lloyd.assigned(_weighted(points), final))  # the summary reads it twice
    place = F.get(centroid_array(final), F.col("cluster"))
    report = score_summary(located, "cluster", "y", "w").withColumn("at", place).select("*", "at.cx", "at.cy")
    index = F.expr(f"cx div {int(spread)}").cast("int")
    return report.select(
        "cluster", "cx", "cy", F.get(F.lit(list(domains)), index).alias("domain"), "size", "median", "avg"
    ).orderBy("avg", "cluster")


def _weighted(points: DataFrame) -> DataFrame:
    return points if "w" in points.columns else postings.weighted_points(points)
