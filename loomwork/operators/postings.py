"""Questions with their best answer, and the integer points made of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUESTION, ANSWER = 1, 2


def scored_questions(postings: DataFrame) -> DataFrame:
    """Answered questions as ``(id, tags, score, best)``; ``best`` is the best answer score, at least 0.

    Answers are hash-aggregated to their best score, so a question with very many answers is reduced before the shuffle,
    and questions to one row per id: of those that share an id the one with the smallest tag stands for all. The two
    reduced sides are joined by the key they are partitioned by.
    """
    answers = postings.filter((F.col("posting_type") == ANSWER) & F.col("parent_id").isNotNull())
    best = answers.groupBy(F.col("parent_id").alias("id")).agg(F.max("score").alias("best"))
    question = F.struct(F.col("tags").isNull().alias("untagged"), "tags", "score")
    questions = postings.filter((F.col("posting_type") == QUESTION) & F.col("id").isNotNull())
    asked = questions.groupBy("id").agg(F.min(question).alias("question"))
    met = asked.join(best, "id").filter(F.col("best").isNotNull())
    return met.select("id", "question.tags", "question.score", F.greatest(F.lit(0), "best").alias("best"))


def domain_points(postings: DataFrame, domains: Sequence[str], spread: int) -> DataFrame:
    """``(id, x, y)`` of the answered questions with a tag: x is its position in ``domains`` times ``spread``, y the best
    answer score.

    An unlisted tag has position -1. Tags become numbers in their order before grouping, so one pass over the postings
    and one hash aggregation on the question id give the smallest tag and the best answer at once.
    """
    is_question, is_answer = F.col("posting_type") == QUESTION, F.col("posting_type") == ANSWER
    ordered = sorted(set(domains))
    # 2i + 1 for the i-th listed tag, even numbers for what lies between.
    before = reduce(lambda a, b: a + b, [F.when(F.col("tags") > d, 2).otherwise(0) for d in ordered], F.lit(0))
    tag = F.when(F.col("tags").isNotNull(), before + F.col("tags").isin(ordered).cast("int"))
    grouped = (
        postings.filter(is_question | is_answer)
        .groupBy(F.when(is_question, F.col("id")).otherwise(F.col("parent_id")).alias("id"))
        .agg(F.min(F.when(is_question, tag)).alias("tag"), F.max(F.when(is_answer, F.col("score"))).alias("best"))
        .filter(F.col("id").isNotNull() & F.col("tag").isNotNull() & F.col("best").isNotNull())
    )
    positions = F.lit([list(domains).index(d) for d in ordered])
    position = F.when(F.col("tag") % 2 == 1, F.get(positions, F.shiftright("tag", 1))).otherwise(-1)
    return grouped.select(
        "id",
        (position * F.lit(spread).cast("bigint")).alias("x"),
        F.greatest(F.lit(0), "best").cast("bigint").alias("y"),
    )


def weighted_points(points: DataFrame) -> DataFrame:
    """Equal points as one row ``(x, y, w)``. Means, sizes and medians stay exact, and rounds read far fewer rows."""
    return points.groupBy("x", "y").agg(F.count("*").alias("w"))
