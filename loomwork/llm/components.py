"""Connected components of a graph given as a table of edges.

Randomised contraction: in each round every node moves to that of itself and its neighbours which a hash of the round
ranks first. Nodes that moved to one place become one node, and edges inside it disappear. A round leaves a constant
share of the nodes in expectation, whatever the shape of the graph, so a path and a star both end after a number of
rounds logarithmic in their size. The moves of all rounds, composed from the last to the first, name the components.

A node with very many edges is reduced on the map side, and the joins by it have a unique other side, which adaptive
execution can split. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.staging import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (two columns of one type, any direction, loops and NULLs ignored).

    ``component`` is some node of the component, the same for all of them.
    """
    a, b = edges.columns
    one_way = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    left = staged(one_way.unionByName(one_way.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), in_loop=True)
    moves: list[DataFrame] = []
    while not left.isEmpty():
        rank = [F.xxhash64(F.lit(len(moves)), F.col(c)) for c in ("u", "v")]
        nearest = left.groupBy("u").agg(F.min(rank[1]).alias("first"), F.min_by("v", rank[1]).alias("v"))
        move = staged(nearest.select("u", F.when(F.col("first") < rank[0], F.col("v")).otherwise(F.col("u")).alias("to")), in_loop=True)
        moved = left.join(move, "u").select("v", F.col("to").alias("a"))
        moved = moved.join(move.withColumnRenamed("u", "v"), "v").select("a", F.col("to").alias("b"))
        contracted = staged(moved.where("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), in_loop=True)
        discard(left)
        left = contracted
        moves.append(move)
    if not moves:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = moves.pop()
    while moves:
        later = found.select(F.col("u").alias("to"), F.col("to").alias("last"))
        found = moves.pop().join(later, "to", "left").select("u", F.coalesce("last", "to").alias("to"))
    return staged(found.select(F.col("u").alias("node"), F.col("to").alias("component")))
