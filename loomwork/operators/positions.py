"""Positions of rows in the order of the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.staging import staged

_IN_PARTITION = (1 << 33) - 1


def numbered(rows: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``rows`` with their position from 0 on, in a column ``name``; rows that are equal in ``order`` in any order.

    Rows are dealt by range of ``order`` and sorted inside each range. A row's position is its place in its range and the
    number of rows in the ranges before, so only one count for each range leaves the tasks, and no task sees all rows.
    NULLs come first unless ``order`` says otherwise.
    """
    place = F.struct(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(_IN_PARTITION).alias("at"))
    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, place))
    counts = placed.groupBy(F.col(name)["part"].alias("part")).count().collect()
    before, offsets = 0, []
    for row in sorted(counts):
        offsets.append((row.part, before))
        before += row["count"]
    starts = rows.sparkSession.createDataFrame(offsets, "part int, start long").select(F.col("part").alias("_part"), F.col("start").alias("_start"))
    joined = placed.join(F.broadcast(starts), F.col(name)["part"] == F.col("_part"))
    return joined.select(*rows.columns, (F.col("_start") + F.col(name)["at"]).alias(name))
