"""Words and tokens of whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that separate words. Vertical tab is not one of them, so `\s` would be wrong here.
WORD_SEPARATORS = "[ \t\n\r\f]+"


def words(text: Column) -> Column:
    """Words of a text in order; case and punctuation stay. May start or end with one empty string."""
    return F.split(text, WORD_SEPARATORS, -1)
