"""Validity intervals, interval joins and as-of lookups."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_intervals(history: DataFrame, key: str, start: str) -> DataFrame:
    """Append-only history → half-open ``[start, valid_to)`` rows, null = open.

    The window holds one key's versions, at most one per calendar day by grain.
    """
    ties = [F.col(c).asc_nulls_last() for c in history.columns if c not in (key, start)]
    order = Window.partitionBy(key).orderBy(F.col(start).asc_nulls_last(), *ties)
    return history.withColumn("valid_to", F.lead(start).over(order)).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def interval_join(
    events: DataFrame, versions: DataFrame, key: str, event_date: str
) -> DataFrame:
    """Inner join of each event with the version valid on its date.

    Equality on the key with the range as a residual: a broadcast hash join when
    the versions turn out small, else a sort-merge join whose hot keys adaptive
    execution splits on the event side. Nothing is hinted. Callers that only
    aggregate should aggregate to (key, date) first.
    """
    v = versions.withColumnRenamed(key, "_version_key")
    day = events[event_date]
    return events.join(
        v,
        (events[key] == v["_version_key"])
        & (v["valid_from"] <= day)
        & (v["valid_to"].isNull() | (day < v["valid_to"])),
    ).drop("_version_key")


#: Values of all curves that tasks may receive, some 32 MB; more are joined in salts.
MOST_VALUES = 2_000_000
SALTS = 64


@dataclass(frozen=True)
class Curves:
    """Per key a value for every day from its first to its last published one.

    ``rows`` has the key columns, ``_first`` day and ``_values`` by days from there, so a
    row is looked up by its distance. A curve is as long as its calendar, however many
    rows look it up; ``size`` counts the values of all of them.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    value: str
    size: int


def curves(
    series: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str,
    stored: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Curves:
    """The sparse dated series as curves; of several values of a day the largest counts.

    ``stored`` may write the curves, which are then computed once. Days are made unique
    first, so what is gathered per key is at most its calendar.
    """
    points = (
        series.where(F.col(day).isNotNull())
        .groupBy(*keys, F.col(day).alias("_day"))
        .agg(F.max(value).alias("_value"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_day", "_value"))).alias("_points"))
    )

    def until_next(point: Column, place: Column) -> Column:
        next_day = F.get(F.col("_points"), place + 1)["_day"]
        days = F.coalesce(F.datediff(next_day, point["_day"]), F.lit(1))
        return F.array_repeat(point["_value"], days)

    filled = F.flatten(F.transform("_points", until_next))
    rows = stored(
        points.select(
            *keys, F.get("_points", F.lit(0))["_day"].alias("_first"), filled.alias("_values")
        )
    )
    size = rows.agg(F.sum(F.size("_values"))).first()[0] or 0
    return Curves(rows, tuple(keys), value, size)


def look_up(
    rows: DataFrame,
    found: Curves,
    keys: Sequence[str],
    day: str | Column,
    most_values: int = MOST_VALUES,
) -> DataFrame:
    """Left join of the curve's value on each row's day, or the last one before it.

    ``keys`` are the row columns in the order of the curves' keys. Rows before the first
    publication, without a day, or with an unknown key, get null. Curves whose counted
    size allows it are sent to all tasks, whatever the session's threshold; others are
    repeated for some salts, so that a key with most rows is many keys.
    """
    named = [f"_key_{i}" for i in range(len(keys))]
    listed = found.rows.select(
        *[F.col(c).alias(n) for c, n in zip(found.keys, named)], "_first", "_values"
    )
    on = [F.col(left) == F.col(right) for left, right in zip(keys, named)]
    probe = rows
    if found.size <= most_values:
        listed = F.broadcast(listed)
    else:
        probe = rows.withColumn("_salt", F.monotonically_increasing_id() % SALTS)
        listed = listed.withColumn(
            "_of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        ).withColumn("_of_salt", F.col("_of_salt").cast("long"))
        on.append(F.col("_salt") == F.col("_of_salt"))
    at = F.datediff(F.col(day) if isinstance(day, str) else day, F.col("_first"))
    value = F.get("_values", F.least(at, F.size("_values") - 1))
    return probe.join(listed, on, "left").select(
        *[F.col(c) for c in rows.columns], F.when(at >= 0, value).alias(found.value)
    )


def asof_join(
    rows: DataFrame,
    series: DataFrame,
    keys: dict[str, str],
    row_date: str | Column,
    series_date: str,
    value: str,
) -> DataFrame:
    """Left join of the latest ``value`` dated on or before each row's date.

    ``keys`` maps row columns to series columns. The series is made into curves and
    counted at once, see ``curves`` and ``look_up``.
    """
    found = curves(series, list(keys.values()), series_date, value)
    return look_up(rows, found, list(keys), row_date)


def key_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct key values that occur in any of the frames."""
    parts = [frame.select(*keys) for frame in frames]
    return reduce(DataFrame.unionByName, parts).distinct()
