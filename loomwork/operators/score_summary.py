"""Size, exact median and mean per group without gathering a group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Values of one cell share all but their lowest 16 bits: 32-bit values make at most 65,536 cells of 65,536 values.
CELL_BITS = 16


def score_summary(df: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """``(group, size, median, avg)`` of weighted whole numbers, for few groups.

    The median of an even number of values is half the sum of the middle two; it and the mean are truncated. The
    weights per cell locate the one or two cells that hold the middle ranks, and only the values of those cells are
    ranked one by one. Both windows see summed weights, never rows, and 32-bit values bound them to 65,536 each.
    """
    v, w = F.col(value).cast("bigint"), F.col(weight)
    valued = df.select(group, F.shiftright(v, CELL_BITS).alias("cell"), v.alias("v"), w.alias("w"))

    per_cell = valued.groupBy(group, "cell").agg(F.sum("w").alias("w"), F.sum(F.col("v") * F.col("w")).alias("sum"))
    whole = Window.partitionBy(group)
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = per_cell.select(
        group,
        "cell",
        F.sum("w").over(upto).alias("until"),
        (F.sum("w").over(upto) - F.col("w")).alias("before"),
        F.sum("w").over(whole).alias("size"),
        F.sum("sum").over(whole).alias("total"),
    )
    middle = F.array(F.expr("(size + 1) div 2"), F.expr("size div 2 + 1"))
    wanted = (
        ranked.select("*", F.posexplode(middle).alias("side", "rank"))
        .filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("until")))
        .drop("until")
    )

    keys = [group, "side", "rank", "before", "size", "total"]
    values = valued.join(wanted, [group, "cell"]).groupBy(*keys, "v").agg(F.sum("w").alias("w"))
    within = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = values.withColumn("until", F.col("before") + F.sum("w").over(within)).filter(
        (F.col("until") - F.col("w") < F.col("rank")) & (F.col("rank") <= F.col("until"))
    )
    middles = hits.groupBy(group, "size", "total").agg(F.sum("v").alias("both"))
    return middles.select(
        group, "size", F.expr("both div 2").alias("median"), F.expr("total div size").alias("avg")
    )
