from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators.positions import numbered


def test_positions_follow_the_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), (F.col("id") % 3).alias("y"))
    got = numbered(rows, "position", "y", F.desc("x")).collect()
    want = sorted(rows.collect(), key=lambda r: (r.y, -r.x))
    assert [(r.x, r.y) for r in sorted(got, key=lambda r: r.position)] == [(r.x, r.y) for r in want]
    assert sorted(r.position for r in got) == list(range(5000))


def test_nulls_ties_and_empty_tables(spark):
    rows = spark.createDataFrame([(None,), (2,), (2,), (1,), (None,)], "x int")
    got = sorted(numbered(rows, "n", "x").collect(), key=lambda r: r.n)
    assert [r.x for r in got] == [None, None, 1, 2, 2] and [r.n for r in got] == [0, 1, 2, 3, 4]
    assert numbered(rows.where("false"), "n", "x").collect() == []


def test_no_window_over_all_rows(spark):
    plan = numbered(spark.range(100), "n", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
