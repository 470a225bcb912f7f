"""The most frequent words two corpora have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.hot_keys import BROADCAST_LIMIT
from loomwork.operators.word_counts import common_counts, corpus_words, counts_without


def top_common_words(corpus: DataFrame, stop: DataFrame, k: int = 20, few: int = BROADCAST_LIMIT) -> DataFrame:
    """Top ``k`` words of a two-source ``(source, text)`` corpus by the smaller count; ties go by word."""
    return common_counts(counts_without(corpus_words(corpus), stop, few)).select("count", "word").orderBy(F.desc("count"), "word").limit(k)
