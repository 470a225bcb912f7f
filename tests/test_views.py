from __future__ import annotations

import pytest

from checks import registry, views


@pytest.fixture
def tables(spark, tmp_path):
    """Write orders of two customers whose lines name the given parts."""

    def write(*parts: int) -> str:
        spark.createDataFrame([(1, 10), (2, 20)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
        lines = [(order, part, float(part % 7)) for order in (1, 2) for part in parts]
        spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
        return str(tmp_path)

    return write


def test_part_numbers_beyond_four_bytes_are_items(spark, tables):
    folder = tables(5, 1_200_000)
    large = 1_200_000 * 5003
    pairs = {(r.item1, r.item2): r.n for r in registry.part_co_occurrence(spark, folder).collect()}
    assert pairs == {(25015, large): 2, (large, 25015): 2, (25015, 25015): 0, (large, large): 0}
    vectors = {(r.user, r.block): r.scores for r in registry.user_score_vectors(spark, folder).collect()}
    assert set(vectors.values()) == {f"25015:5.0:1,{large}:{float(1_200_000 % 7)}:1"} and set(vectors) == {(10, 0), (20, 0)}


def test_small_part_numbers_stay_int(spark, tables):
    assert dict(views.part_ratings(spark, tables(5, 6)).dtypes)["item"] == "int"


def test_many_lines_are_joined_in_partitions_of_bounded_size(spark, tables, monkeypatch):
    monkeypatch.setattr(views, "ROWS", 1, raising=False)
    folder = tables(*range(1, 21))
    found = views.part_ratings(spark, folder)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 40 and found.select("user", "item").distinct().count() == 40
