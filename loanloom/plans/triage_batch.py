"""The whole message triage in one call, every message scored once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.plans.triage import ReplyBook, score_messages, summarize, triage_decided
from loanloom.sources.export import write_report
from loanloom.sources.layers import Layers
from loanloom.sources.messages import parse_decisions, parse_messages, require_valid


def run_triage(
    spark: SparkSession,
    source: str,
    target: str,
    scorer: Callable[[str], dict],
    book: ReplyBook,
) -> DataFrame:
    """Reads, scores, rules on and reports a folder of messages; returns the summary.

    Lines are parsed once and stored, and so are the scored decisions: checks, results
    and summary all read what is stored, so a message is scored once and the report
    agrees with itself. A bad line or a repeated id is an error before any scoring.
    """
    layers = Layers(spark, target)
    lines = spark.read.text(source).withColumn("file", F.input_file_name())
    parsed = layers.write(parse_messages(lines), "bronze", "messages")
    require_valid(parsed)
    messages = parsed.select("id", "channel", "received_at", "from", "text")
    return report_batch(messages, layers, scorer, book)


def report_batch(
    messages: DataFrame, layers: Layers, scorer: Callable[[str], dict], book: ReplyBook
) -> DataFrame:
    """Scores checked messages and writes decisions, results and the report."""
    decided = layers.write(
        parse_decisions(score_messages(messages, scorer)), "silver", "decisions"
    )
    results = layers.write(triage_decided(decided, book), "gold", "results")
    message_count = messages.agg(F.count("*")).scalar()
    summary = (
        summarize(results)
        .withColumn("message_count", message_count)
        .withColumn("complete", F.col("message_count") == F.col("total_messages"))
    )
    summary = layers.write(summary, "gold", "summary")
    write_report(
        results,
        summary,
        f"{layers.root}/report",
        lambda df: layers.write(df, "gold", "results_in_order"),
    )
    return summary
