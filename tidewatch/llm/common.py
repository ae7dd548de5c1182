"""Word expressions and small helpers shared by the corpus operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The six blanks that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[ \t\n\x0B\f\r]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The runs of non-blank characters, in order; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    none = F.lit([]).cast("array<string>")
    return F.when(bare == "", none).otherwise(F.split(bare, BLANK_RUN))


def keep_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns ``names`` of ``df``, each quoted so that a name with dots or spaces is read as one column."""
    return df.select(*[F.col(f"`{n}`") for n in names])
