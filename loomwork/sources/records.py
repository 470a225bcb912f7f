"""Ratings and forum postings from comma-separated lines without a header.

A line is parsed once into its fields and the reason for which it cannot be used, the name of the first bad field. A
malformed line fails the query by default, whichever columns it selects: the check is a filter, which pruning of
columns leaves alone. ``malformed="skip"`` leaves such lines out instead, and ``sorted_out`` keeps both: the good rows, and
the rejected lines with their reasons as a table of their own, from one pass over the lines. CSV readers are not
used: lines may rightly be longer or shorter than the schema, which they either reject or read as silent NULLs.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.parsing import checked, double_or_null, field, int_or_null, parsed, reason
from loomwork.sources.text_files import read_lines
from loomwork.staging import staged


class Sorted(NamedTuple):
    """Rows of good lines, and ``(value, reason)`` of the others."""

    rows: DataFrame
    rejected: DataFrame


def rating(parts: Column) -> Column:
    """``user,item,score[,…]``."""
    user, item, score = int_or_null(field(parts, 0)), int_or_null(field(parts, 1)), double_or_null(field(parts, 2))
    why = reason(user=user.isNotNull(), item=item.isNotNull(), score=score.isNotNull())
    return F.struct(user.alias("user"), item.alias("item"), score.alias("score"), why.alias("reason"))


def timed_rating(parts: Column) -> Column:
    """``user,item,score,time[,…]``; the time is any text that sorts by time."""
    told = rating(parts)
    why = F.coalesce(told["reason"], F.when(F.coalesce(field(parts, 3), F.lit("")) == "", "time"))
    return F.struct(told["user"].alias("user"), told["item"].alias("item"), told["score"].alias("score"), field(parts, 3).alias("time"), why.alias("reason"))


def posting(parts: Column) -> Column:
    """``type,id,[parent],score[,tag]``; the parent may be empty."""
    kind, number, score = (int_or_null(field(parts, i)) for i in (0, 1, 3))
    given, parent = field(parts, 2), int_or_null(field(parts, 2))
    why = reason(
        posting_type=kind.isNotNull(), id=number.isNotNull(), parent_id=(given == "") | parent.isNotNull(), score=score.isNotNull()
    )
    return F.struct(
        kind.alias("posting_type"), number.alias("id"), parent.alias("parent_id"), score.alias("score"), field(parts, 4).alias("tags"),
        why.alias("reason"),
    )


def read_ratings(spark: SparkSession, path: str, malformed: str = "raise") -> DataFrame:
    return parse_ratings(read_lines(spark, path), malformed)


def read_postings(spark: SparkSession, path: str, malformed: str = "raise") -> DataFrame:
    return parse_postings(read_lines(spark, path), malformed)


def parse_ratings(lines: DataFrame, malformed: str = "raise") -> DataFrame:
    """``(user INT, item INT, score DOUBLE)`` of lines in a column ``value``."""
    return _good(parsed(lines, rating), malformed)


def parse_timed_ratings(lines: DataFrame, malformed: str = "raise") -> DataFrame:
    """``(user INT, item INT, score DOUBLE, time STRING)`` of lines in a column ``value``."""
    return _good(parsed(lines, timed_rating), malformed)


def parse_postings(lines: DataFrame, malformed: str = "raise") -> DataFrame:
    """``(posting_type INT, id INT, parent_id INT?, score INT, tags STRING?)`` of lines in a column ``value``."""
    return _good(parsed(lines, posting), malformed)


def sorted_out(lines: DataFrame, parse: Callable[[Column], Column]) -> Sorted:
    """Good and rejected lines apart; ``parse`` is ``rating``, ``timed_rating`` or ``posting``. The parsed lines are staged: both read them."""
    table = staged(parsed(lines, parse))
    rows = table.where("reason is null").drop("value", "reason")
    return Sorted(rows, table.where("reason is not null").select("value", "reason"))


def _good(table: DataFrame, malformed: str) -> DataFrame:
    if malformed not in ("raise", "skip"):
        raise ValueError("malformed must be 'raise' or 'skip'")
    good = F.col("reason").isNull()
    return table.filter(good if malformed == "skip" else checked(good, F.col("value"))).drop("value", "reason")
