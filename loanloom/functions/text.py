"""Text cleanup and phrase matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    """Trim spaces; an empty rest is null."""
    return F.nullif(F.trim(text), F.lit(""))


def is_blank(text: Column) -> Column:
    """True when nothing but Unicode whitespace is left (or the value is null)."""
    return F.coalesce(~text.rlike(r"(?U)\S"), F.lit(True))


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """True when any phrase occurs as a substring."""
    return reduce(or_, [text.contains(phrase) for phrase in phrases])


def has_word(text: Column, words: Sequence[str]) -> Column:
    """True when any word occurs whole; accented letters count as letters."""
    return text.rlike(r"(?U)\b(" + "|".join(words) + r")\b")
