"""Collapse change logs and duplicate records to one row per key.

All of these are plain aggregates, so rows are combined before the shuffle: a
key that owns a third of the log still reaches the reducer as one row per map
task. ``max`` of a struct compares its fields in order with nulls lowest, which
is the same as taking row 1 of "descending, nulls last".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Whole row with the greatest order columns; the other columns break ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return F.max(F.struct(*order, *rest))


def latest_state(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    **aggregates: Column,
) -> DataFrame:
    """Latest row per key plus aggregates over the key's whole history.

    Exact duplicates change neither the latest row nor min/max aggregates, so
    the log needs no separate deduplication first.
    """
    extra = [column.alias(name) for name, column in aggregates.items()]
    picked = log.groupBy(*keys).agg(_newest(log, keys, order).alias("_row"), *extra)
    return picked.select(*keys, "_row.*", *aggregates)


def survivor(
    records: DataFrame, keys: Sequence[str], order: Sequence[str], id_column: str
) -> DataFrame:
    """Best record per key, with the number of distinct ids that share the key."""
    return latest_state(
        records, keys, order, **{f"{id_column}_count": F.count_distinct(id_column)}
    )


def known_id_per_key(
    log: DataFrame, key: str, id_column: str, sentinel: int, master: DataFrame
) -> DataFrame:
    """The real id found in the history of each key that ever shows the sentinel.

    An id is real when ``master`` has it. One pass: pairs of key and id are made
    distinct first, so copies never travel and the window holds a key's different
    ids only. Just histories with a sentinel are looked up in the master.
    """
    ever = F.max(F.col(id_column) == sentinel).over(Window.partitionBy(key))
    candidates = (
        log.select(key, id_column)
        .distinct()
        .withColumn("_affected", ever)
        .where(F.col("_affected") & (F.col(id_column) != sentinel))
        .drop("_affected")
    )
    return (
        candidates.join(master.select(id_column), id_column, "left_semi")
        .groupBy(key)
        .agg(F.min(id_column).alias(f"known_{id_column}"))
    )


def repair_sentinel(
    rows: DataFrame, known: DataFrame, key: str, id_column: str, sentinel: int
) -> DataFrame:
    """Replace the sentinel by the key's known id, or null when none is known."""
    found = f"known_{id_column}"
    return (
        rows.join(known, key, "left")
        .withColumn(
            id_column,
            F.when(F.col(id_column) == sentinel, F.col(found)).otherwise(
                F.col(id_column)
            ),
        )
        .drop(found)
    )
