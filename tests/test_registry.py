from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from checks import oracles, registry
from checks.compare import ROOT, duckdb_tables, sorted_rows
from loomwork.operators.word_counts import counts_without

TINY = f"{ROOT}/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(TINY)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_result_equals_sql(spark, tables, name):
    df = driver.queries()[name](spark, TINY)
    mine = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    result = tables.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == sorted_rows(columns, result.fetchall())
    assert mine


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql()) | registry.WITHOUT_SQL
    assert set(registry.queries()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 20


LAZY = ["word_counts_by_source", "top_common_words", "user_score_vectors", "co_occurrence", "score_products",
        "recommend", "scored_questions", "domain_points", "sample_centroids", "lloyd_step", "cluster_report",
        "w2v_vocabulary"]


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_cross_join_and_no_python(spark, name, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = driver.queries()[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert bad not in plan


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(driver.queries()["domain_points"](spark, TINY))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert [s.count(":") for s in schemas] == [4, 2]
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan


def test_common_words_shuffle_once_and_cut_without_a_full_sort(spark):
    plan = plan_of(driver.queries()["top_common_words"](spark, TINY))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in plan
    # The plan is printed from its result down: stop words go before the first aggregation.
    assert plan.rindex("HashAggregate") < plan.index("BroadcastHashJoin")


def test_a_long_stop_list_is_joined_with_the_counts(spark):
    tokens = spark.createDataFrame([(0, "a"), (1, "a"), (0, "b"), (1, "c")], "source int, word string")
    stop = spark.createDataFrame([("b",), ("x",)], "word string")
    short, long = counts_without(tokens, stop), counts_without(tokens, stop, few=1)
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long.collect())) == [("a", 1, 1), ("c", 0, 1)]
    assert plan_of(long).index("Join") < plan_of(long).index("HashAggregate")


def test_tokens_come_without_opaque_functions(spark):
    plan = plan_of(driver.queries()["clean_tokens"](spark, TINY))
    assert "UDF" not in plan


def test_questions_and_answers_meet_in_one_shuffle(spark):
    assert plan_of(driver.queries()["domain_points"](spark, TINY)).count("Exchange") == 1


def test_the_summed_products_need_no_second_shuffle_before_the_exclusion(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(driver.queries()["recommend"](spark, TINY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Scores, matrix rows, sums, rated pairs.
    assert plan.count("Exchange hashpartitioning") == 4


def test_places_come_without_a_window_over_all_lines(spark):
    plan = plan_of(driver.queries()["ordered_recommendations"](spark, TINY))
    assert "Window" not in plan and "SinglePartition" not in plan
