"""Distances between integer points and the nearest of a few centroids."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared Euclidean distance as a double."""
    dx, dy = (x1 - x2).cast("double"), (y1 - y2).cast("double")
    return dx * dx + dy * dy


def centroid_array(centroids: Sequence[tuple[int, int]]) -> Column:
    """The centroids as one constant ``ARRAY<STRUCT<cx, cy>>``.

    Parsed from one JSON literal, which the planner folds: an expression per number would cost more than the round.
    """
    items = json.dumps([{"cx": int(cx), "cy": int(cy)} for cx, cy in centroids])
    return F.from_json(F.lit(items), "array<struct<cx: bigint, cy: bigint>>")


def nearest(x: Column, y: Column, centroids: Sequence[tuple[int, int]]) -> Column:
    """Index of the nearest centroid; the lowest index wins ties. -1 if there are none.

    It is never NULL and says so: joins on it would else filter by it first and compute all distances twice.
    The centroids are one constant array of the plan, so its shape, and with it the generated code, is the same in
    every round of a loop.
    """
    distances = F.transform(centroid_array(centroids), lambda c: squared_distance(x, y, c["cx"], c["cy"]))
    return F.coalesce(F.array_position(distances, F.array_min(distances)).cast("int") - 1, F.lit(-1))
