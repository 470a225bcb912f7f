"""Strict typed fields out of comma-separated lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fields(line: Column) -> Column:
    """Split at commas; empty fields at the end of the line do not count as fields."""
    return F.split(F.rtrim(line, F.lit(",")), ",", -1)


def field(parts: Column, position: int) -> Column:
    """Field by position, NULL where the line is too short."""
    return F.get(parts, F.lit(position))


def int_or_null(text: Column) -> Column:
    """Whole number without surrounding blanks, else NULL."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def double_or_null(text: Column) -> Column:
    return text.try_cast("double")


def reason(**wanted: Column) -> Column:
    """The name of the first condition that does not hold, NULL if all do."""
    return F.coalesce(*[F.when(F.coalesce(holds, F.lit(False)), F.lit(None)).otherwise(name.rstrip("_")) for name, holds in wanted.items()])


def parsed(lines: DataFrame, parse: Callable[[Column], Column], line: str = "value") -> DataFrame:
    """``lines`` with the fields of the struct that ``parse`` makes of a line's parts.

    The line is split once and the struct made once: it comes out of a generator, behind which the planner cannot repeat
    the expressions that make the line, whatever is later selected or tested.
    """
    return lines.select(line, F.inline(F.transform(F.array(fields(F.col(line))), parse)))


def checked(good: Column, line: Column) -> Column:
    """A condition that is true, or a failing query that shows the line, whatever the ANSI mode of the session."""
    failure = F.raise_error(F.concat(F.lit("malformed line: "), line)).cast("boolean")
    return F.when(good, F.lit(True)).otherwise(failure)
