"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word, as all operators and contracts here count them.
WORD = r"[^\x20\x09-\x0D]+"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows in the folder that all executors share; lineage ends there.

    The folder is the session's ``spark.checkpoint.dir``. None is made up: a folder
    of one machine would be lost with it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    return folder


def word_count(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def training_row(doc_id: Column) -> Column:
    """Whether a row's label may be learned: crc32 of the id's text, modulo 3, is not 1."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(remainder != 1, F.lit(False))


def running_start(
    df: DataFrame,
    group: list[str],
    chunk: str,
    order: Iterable[str],
    amount: str,
    into: str,
) -> DataFrame:
    """Adds the exclusive running sum of ``amount`` in each group, by chunk and order.

    A group may hold most rows, so no window spans one: sums per (group, chunk) come
    first, their running sum gives each chunk its start, and a window runs within a
    chunk only. ``chunk`` must ascend with the wished order; it and the group's columns
    are null nowhere, so that join and window share one partitioning.
    """
    keys = [*group, chunk]
    totals = df.groupBy(*keys).agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*group).orderBy(chunk)
    starts = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        (F.sum("_total").over(before) - F.col("_total")).alias("_start"),
    )
    matched = F.lit(True)
    for k in keys:
        matched = matched & (F.col(k) == F.col(f"_k_{k}"))
    within = Window.partitionBy(*keys).orderBy(*order)
    inside = df.withColumn(
        "_inside",
        F.sum(amount).over(within.rowsBetween(Window.unboundedPreceding, 0))
        - F.col(amount),
    )
    return (
        inside.join(starts, matched)
        .withColumn(into, F.col("_start") + F.col("_inside"))
        .drop("_inside", "_start", *[f"_k_{k}" for k in keys])
    )
