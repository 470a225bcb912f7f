from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators.word_counts import corpus_words, counts_by_source
from loomwork.plans.common_words import top_common_words
from tests.conftest import rows


def corpus(spark, texts0, texts1):
    tagged = [(0, t) for t in texts0] + [(1, t) for t in texts1]
    return spark.createDataFrame(tagged, "source int, text string")


def stop(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def top(df):
    return [tuple(row) for row in df.collect()]


def test_words_keep_case_and_punctuation(spark):
    words = corpus_words(corpus(spark, [" a\tb. \n c", "", None, "x\x0by"], []))
    assert rows(words) == [(0, "a"), (0, "b."), (0, "c"), (0, "x\x0by")]


def test_counts_by_source(spark):
    counts = counts_by_source(corpus_words(corpus(spark, ["a b a"], ["a"])))
    assert rows(counts) == [("a", 0, 2), ("a", 1, 1), ("b", 0, 1)]


def test_a_word_of_one_corpus_in_many_partitions_is_not_common(spark):
    split = corpus(spark, ["x", "x", "x", "y"], ["y"]).repartition(4)
    assert top(top_common_words(split, stop(spark))) == [(1, "y")]


def test_ties_go_by_word_and_k_cuts(spark):
    words = [f"w{i:02d}" for i in range(21)]
    text = " ".join(reversed(words))
    assert top(top_common_words(corpus(spark, [text], [text]), stop(spark))) == [(1, w) for w in words[:20]]
    assert top(top_common_words(corpus(spark, [text], [text]), stop(spark), k=2)) == [(1, "w00"), (1, "w01")]


def test_the_smaller_count_ranks(spark):
    assert top(top_common_words(corpus(spark, ["a a a b b"], ["a b b b"]), stop(spark))) == [(2, "b"), (1, "a")]


def test_stop_words_match_exactly(spark):
    text = "It it it."
    assert top(top_common_words(corpus(spark, [text], [text]), stop(spark, "it", "it"))) == [(1, "It"), (1, "it.")]


def test_without_stop_words_all_words_rank(spark):
    text = "the the cat"
    assert top(top_common_words(corpus(spark, [text], [text]), stop(spark))) == [(2, "the"), (1, "cat")]


def test_a_stop_list_too_large_to_broadcast_gives_the_same(spark):
    words = ["the", "of", "cat"] * 3 + ["dog"]
    texts = corpus(spark, [" ".join(words)], [" ".join(words)])
    small = spark.range(1).select(F.explode(F.lit(["the", "of"])).alias("word"))
    expected = top(top_common_words(texts, small))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = top_common_words(texts, small, few=1)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert top(joined) == expected == [(3, "cat"), (1, "dog")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
