"""Word counts per corpus and the words two corpora share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import words
from loomwork.operators.hot_keys import BROADCAST_LIMIT


def corpus_words(corpus: DataFrame) -> DataFrame:
    """``(source, text)`` → one ``(source, word)`` per occurrence."""
    exploded = corpus.select("source", F.explode(words(F.col("text"))).alias("word"))
    return exploded.filter(F.col("word") != "")


def without_stop_words(tokens: DataFrame, stop: DataFrame) -> DataFrame:
    """Drop rows whose ``word`` is in ``stop``, compared exactly.

    No broadcast is forced; ``counts_without`` decides by the size of the list.
    """
    return tokens.join(stop.select("word"), "word", "left_anti")


def counts_without(tokens: DataFrame, stop: DataFrame, few: int = BROADCAST_LIMIT) -> DataFrame:
    """``(word, n0, n1)`` of all words but the stop words.

    A stop list of at most ``few`` rows, counted first, is broadcast and leaves out occurrences before they are
    counted and shuffled. A longer one is joined with the counted words.
    """
    if stop.limit(few + 1).count() > few:
        return without_stop_words(paired_counts(tokens), stop)
    return paired_counts(without_stop_words(tokens, F.broadcast(stop)))


def counts_by_source(tokens: DataFrame) -> DataFrame:
    """``(word, source, n)``."""
    return tokens.groupBy("word", "source").agg(F.count("*").alias("n"))


def paired_counts(tokens: DataFrame) -> DataFrame:
    """``(word, n0, n1)``: both counts of a word from one shuffle, no join of the two sides."""
    return tokens.groupBy("word").agg(
        F.count_if(F.col("source") == 0).alias("n0"), F.count_if(F.col("source") == 1).alias("n1")
    )


def common_counts(pairs: DataFrame) -> DataFrame:
    """Words of both corpora with the smaller of their two counts."""
    return pairs.select("word", F.least("n0", "n1").alias("count")).filter(F.col("count") > 0)
