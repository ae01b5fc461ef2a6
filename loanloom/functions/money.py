"""Money, rates and buckets. Money stays decimal; only rates are double."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
USD = "decimal(18,6)"


def _only_ascii(value: Column) -> Column:
    return F.octet_length(value) == F.length(value)


def _shaped(value: Column, kind: str) -> Column:
    """Whether trimmed text has the type's full shape, for text that the cast takes.

    Only shapes that a cast takes beyond the full one need to be told apart, by plain
    comparisons: short dates and dates with a rest, exponents, a missing whole part.
    """
    if kind in ("bigint", "int"):
        return F.lit(True)
    if kind == "date":
        return (
            (F.length(value) == 10)
            & (F.substring(value, 5, 1) == "-")
            & (F.substring(value, 8, 1) == "-")
            & F.substring(value, 10, 1).between("0", "9")
        )
    return (
        _only_ascii(value)
        & ~F.contains(value, F.lit("e"))
        & ~F.contains(value, F.lit("E"))
        & F.substring(F.ltrim(value, F.lit("+-")), 1, 1).between("0", "9")
    )


def readable(text: Column, kind: str) -> Column:
    """The value of trimmed text of the type's full shape; anything else is null.

    ``bigint``, ``int``: a sign and digits. ``date``: yyyy-MM-dd. Decimals: a sign,
    digits, and a point with further digits or none.
    """
    value = F.trim(text)
    read = value.try_cast(kind)
    return read if kind in ("bigint", "int") else F.when(_shaped(value, kind), read)


def strict(text: Column, kind: str) -> Column:
    """Like ``readable``, but text that can't be read, blank included, is an error.

    Whether the session has ANSI mode on makes no difference. Null stays null.
    """
    broken = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
    return F.coalesce(readable(text, kind), F.when(text.isNotNull(), broken))


def parse_money(text: Column) -> Column:
    """Tolerant decimal; unreadable text is null."""
    return F.trim(text).try_cast(MONEY)


def parse_grouped_money(text: Column) -> Column:
    """Like ``parse_money`` for text with thousands commas."""
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast(MONEY)


def from_minor_units(text: Column) -> Column:
    """Whole cents as text → decimal; text that is not a whole number is an error.

    A fraction of a cent or an exponent is refused, whatever the session's ANSI mode.
    """
    cents = F.trim(text).try_cast("bigint").cast("decimal(20,0)")
    broken = F.raise_error(F.concat(F.lit("not whole cents: "), text)).cast(MONEY)
    amount = cents * F.lit(Decimal("0.01"))
    return F.coalesce(amount.try_cast(MONEY), F.when(text.isNotNull(), broken))


def to_usd(amount: Column, units_per_usd: Column, as_type: str = USD) -> Column:
    """Decimal division, rounded half up once.

    The narrow casts leave the quotient 16 digits, so the second rounding to
    ``as_type`` starts from a value that is exact for every practical amount.
    """
    return (amount.cast(MONEY) / units_per_usd.cast(USD)).cast(as_type)


def ratio(part: Column, whole: Column) -> Column:
    """Rate from summed parts; null when the whole is null or zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def bucket(value: Column, edges: Sequence[int]) -> Column:
    """Label for ``0``, ``1-e1``, ``e1+1-e2``, …, ``en+``."""
    label = F.when(value == 0, F.lit("0"))
    low = 1
    for edge in edges:
        label = label.when(value <= edge, F.lit(f"{low}-{edge}"))
        low = edge + 1
    return label.otherwise(F.lit(f"{edges[-1]}+"))
