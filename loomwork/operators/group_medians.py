"""Exact medians for any number of groups, by radix selection.

The two middle ranks of every group are narrowed at once, ``DIGIT_BITS`` bits of the value a round: values that share all
higher bits with a rank's value are counted by their next digit, and the running sum of at most 2^``DIGIT_BITS`` counts says
which digit the rank falls into; rows that no longer matter drop out.

Rows are dealt to as many partitions as give each some ``ROWS`` of them before they are counted, since counts of many groups in
one task would grow with the table. The first counts are dealt by group and value and later steps read distinct
values only, in the order of sorts that spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.staging import staged

DIGIT_BITS = 8
ROWS = 1 << 18


def group_medians(df: DataFrame, group: str, value: str, bits: int = DIGIT_BITS) -> DataFrame:
    """``(group, size, low, high)``: the number of values of each group and its two middle ones, equal if it is odd.

    Values are whole numbers of up to 63 bits of spread; NULL values are left out, and groups without values have no row.
    """
    given = df.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("long").alias("v"))
    bounds = given.agg(F.min("v"), F.max("v"), F.count("*")).first()
    parts = max(1, -(-bounds[2] // ROWS))
    least, width = bounds[0] or 0, ((bounds[1] or 0) - (bounds[0] or 0)).bit_length()
    rounds = max(1, -(-width // bits))
    given = given.select("g", (F.col("v") - F.lit(least)).alias("v")).repartition(parts, "g", "v")
    values = staged(given.groupBy("g", "v").agg(F.count("*").alias("n")))
    sizes = staged(values.repartition(parts, "g").groupBy("g").agg(F.sum("n").alias("size")))
    middle = F.array(F.expr("(size + 1) div 2"), F.expr("size div 2 + 1"))
    ranks = sizes.select("g", F.posexplode(middle).alias("side", "rank")).withColumn("prefix", F.lit(0).cast("long"))
    for step in reversed(range(rounds)):
        ranks = staged(_narrowed(values, ranks, step * bits, bits, parts), in_loop=True)
    low = F.max(F.when(F.col("side") == 0, F.col("prefix"))) + F.lit(least)
    high = F.max(F.when(F.col("side") == 1, F.col("prefix"))) + F.lit(least)
    found = ranks.repartition(parts, "g").groupBy("g").agg(low.alias("low"), high.alias("high"))
    return found.join(sizes.repartition(parts, "g"), "g").select(F.col("g").alias(group), "size", "low", "high")


def _narrowed(values: DataFrame, ranks: DataFrame, shift: int, bits: int, parts: int) -> DataFrame:
    """``ranks`` with one more digit in their ``prefix`` and the rank left among the values that share it."""
    prefix: Column = F.shiftright("v", shift + bits)
    ranks = ranks.withColumnRenamed("prefix", "p").repartition(parts, "g", "p")
    wanted = ranks.select("g", "p").distinct()
    dealt = values.withColumn("p", prefix).repartition(parts, "g", "p")
    counted = dealt.join(wanted, ["g", "p"]).groupBy("g", "p", F.shiftright("v", shift).alias("next")).agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("g", "p").orderBy("next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("until", F.sum("n").over(upto))
    met = placed.join(ranks, ["g", "p"])
    here = met.where((F.col("until") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("until")))
    return here.select("g", "side", (F.col("rank") - F.col("until") + F.col("n")).alias("rank"), F.col("next").alias("prefix"))
