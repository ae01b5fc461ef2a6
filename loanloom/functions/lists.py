"""Small ordered lists held in array columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_without(items: Column, unwanted: Column) -> Column:
    """First occurrences in order, leaving out one value."""
    return F.array_distinct(F.array_remove(items, unwanted))


def evidenced(values: Column, lowered_text: Column) -> Column:
    """Distinct values whose lower-cased form occurs in the lower-cased text."""
    return F.array_distinct(
        F.filter(values, lambda value: F.contains(lowered_text, F.lower(value)))
    )


def first_match(items: Column, outcomes: Mapping[str, str]) -> Column:
    """Outcome of the first key, in mapping order, that is among the items."""
    return F.coalesce(
        *[
            F.when(F.array_contains(items, key), F.lit(outcome))
            for key, outcome in outcomes.items()
        ]
    )


def all_within(items: Column, allowed: Column) -> Column:
    """True when every item is in the allowed list."""
    return F.size(F.array_except(items, allowed)) == 0


def remove_first(items: Column, unwanted: str) -> Column:
    """Drop only the first occurrence of a value."""
    at = F.array_position(items, unwanted).cast("int")
    return F.when(
        at > 0,
        F.concat(
            F.slice(items, F.lit(1), at - 1), F.slice(items, at + 1, F.size(items))
        ),
    ).otherwise(items)
