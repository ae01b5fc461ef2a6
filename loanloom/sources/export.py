"""Ordered CSV exports and JSON reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.instants import parse_utc
from loanloom.operators.running import Stored, with_position
from loanloom.sources.bronze import write_csv


def export_answer(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """One CSV file for an answer of a few rows."""
    one = df.repartition(1)
    write_csv(one.sortWithinPartitions(*order) if order else one, path)


def export_table(df: DataFrame, path: str, grain: Sequence[str]) -> None:
    """A table as CSV files that are sorted and range-partitioned by its grain."""
    write_csv(df.orderBy(*grain), path)


def in_order_of_arrival(results: DataFrame, stored: Stored) -> DataFrame:
    """Adds each result's ``position`` in the report: by instant, stamp as written, id."""
    moment = parse_utc(F.col("received_at"))
    order = [moment.asc_nulls_first(), F.col("received_at"), F.col("id")]
    return with_position(results, order, stored)


def write_report(
    results: DataFrame, summary: DataFrame, path: str, stored: Stored
) -> None:
    """Result rows by the instant of arrival and a one-row summary, as JSON lines.

    Each row carries its ``position``. Null fields are written and text keeps its accents.
    """
    ordered = in_order_of_arrival(results, stored).orderBy("position").drop("received_at")
    ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(
        f"{path}/results"
    )
    summary.repartition(1).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(f"{path}/summary")
