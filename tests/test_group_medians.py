from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from loomwork.operators.group_medians import group_medians
from loomwork.staging import staged


@pytest.mark.parametrize("bits", [3, 8])
def test_equals_sorting(spark, bits):
    deal = random.Random(4)
    rows = [(deal.randrange(40), deal.choice([deal.randint(-10**6, 10**9), deal.randint(0, 3)])) for _ in range(900)] + [(99, None), (7, None), (None, 5), (None, 8)]
    got = {r.g: (r.size, r.low, r.high) for r in group_medians(spark.createDataFrame(rows, "g int, v long"), "g", "v", bits).collect()}
    want = {}
    for g in {g for g, v in rows if v is not None} - {None}:
        values = [v for h, v in rows if h == g and v is not None]
        want[g] = len(values), statistics.median_low(values), statistics.median_high(values)
    got.pop(None, None)
    assert got == want


def test_one_value_equal_values_and_none(spark):
    rows = spark.createDataFrame([(1, 7), (1, 7), (2, 7)], "g int, v int")
    assert sorted(map(tuple, group_medians(rows, "g", "v").collect())) == [(1, 2, 7, 7), (2, 1, 7, 7)]
    assert group_medians(rows.where("false"), "g", "v").collect() == []


def test_no_task_counts_more_rows_as_the_table_grows(spark, monkeypatch):
    from loomwork.operators import group_medians as module

    seen = []

    def kept(df, in_loop=False):
        table = staged(df, in_loop)
        if "v" in table.columns:
            plan = df.withColumn("part", F.spark_partition_id()).groupBy("part").count()
            seen.append(max(row["count"] for row in plan.collect()))
        return table

    monkeypatch.setattr(module, "ROWS", 500, raising=False)
    monkeypatch.setattr(module, "staged", kept)
    for rows in (4_000, 16_000):
        table = spark.range(rows).select((F.col("id") % 1000).alias("g"), F.col("id").alias("v"))
        assert module.group_medians(table, "g", "v").count() == 1000
    assert len(seen) == 2 and max(seen) < 1000, seen
