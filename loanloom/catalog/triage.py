"""Registered queries: message triage over the conversations table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.catalog.lending import Query, opened
from loanloom.functions.text import contains_any, has_word
from loanloom.plans import triage as rules
from loanloom.plans.triage_batch import report_batch
from loanloom.plans import triage_vocabulary as v
from loanloom.samples import triage as samples
from loanloom.samples.triage import BOOK
from loanloom.sources import messages as records
from loanloom.sources.export import write_report

TRIAGE: dict[str, Query] = {}


def query(function: Query) -> Query:
    TRIAGE[function.__name__] = function
    return function


def ruled(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with valid decisions and every rule's outcome."""
    messages = samples.conversation_messages(spark, folder)
    decisions = samples.decisions(spark, folder)
    valid = decisions.withColumn("well_formed", F.lit(True)).where(
        F.size(rules.decision_problems(BOOK)) == 0
    )
    return rules.rule_columns(messages.select("id", "text").join(valid, "id"), BOOK)


def results(spark: SparkSession, folder: str) -> DataFrame:
    return rules.triage(
        samples.conversation_messages(spark, folder),
        samples.decisions(spark, folder),
        BOOK,
    )


def flat(df: DataFrame) -> DataFrame:
    """Results with entities and error spread over plain columns."""
    return df.select(
        *[c for c in df.columns if c not in ("entities", "error", "received_at")],
        *[F.col("entities")[name].alias(name) for name in v.ENTITY_FIELDS],
        F.col("error.type").alias("error_type"),
        F.col("error.message").alias("error_message"),
    )


# Sources


@query
def messages_invalid_rows(spark: SparkSession, folder: str) -> DataFrame:
    parsed = records.parse_messages(samples.message_lines(spark, folder))
    return records.invalid_messages(parsed).select("conv_id", "turn", "problem")


@query
def messages_duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    return records.duplicate_ids(
        records.parse_messages(samples.message_lines(spark, folder))
    )


@query
def decisions_invalid_rows(spark: SparkSession, folder: str) -> DataFrame:
    parsed = records.parse_decisions(samples.decision_json(spark, folder))
    problems = rules.decision_problems(BOOK)
    return parsed.select("id", problems.alias("problems")).where(F.size("problems") > 0)


@query
def triage_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The report written as JSON and its result rows read back."""
    rows = results(spark, folder)
    return flat(_report(spark, rows).drop("position"))


@query
def report_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Where each message stands in the written report, and when it arrived."""
    rows = results(spark, folder)
    arrived = rows.select("id", "received_at")
    return _report(spark, rows).select("id", "position").join(arrived, "id")


def _report(spark: SparkSession, rows: DataFrame) -> DataFrame:
    layers = opened(spark)
    path = layers.path("gold", "report")
    write_report(
        rows,
        rules.summarize(rows),
        path,
        lambda df: layers.write(df, "gold", "results_in_order"),
    )
    schema = rows.drop("received_at").withColumn("position", F.lit(1).cast("long")).schema
    return spark.read.schema(schema).json(f"{path}/results")


@query
def scored_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages scored by a fixed scorer, then triaged."""
    messages = samples.conversation_messages(spark, folder)
    scored = rules.score_messages(messages, samples.length_scorer())
    done = rules.triage_decided(records.parse_decisions(scored), BOOK)
    return flat(done).select(
        "id", "technical_status", "main_reason", "priority", "action", "queue", "error_type"
    )


@query
def triage_report(spark: SparkSession, folder: str) -> DataFrame:
    """The totals of a batch that was scored once and stored."""
    messages = samples.conversation_messages(spark, folder)
    return report_batch(messages, opened(spark), samples.length_scorer(), BOOK).select(
        "message_count", "complete", "total_messages", "business_results", "technical_errors"
    )


# Single rules


@query
def array_dedup_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("id", "intents")


@query
def entity_evidence(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select(
        "id", *[F.col("evidence")[name].alias(name) for name in v.ENTITY_FIELDS]
    )


@query
def priority_match(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("id", "human_queue")


@query
def contextual_queue(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("id", "contextual_queue")


@query
def keyword_whole_word(spark: SparkSession, folder: str) -> DataFrame:
    texts = samples.conversation_messages(spark, folder)
    return texts.select(
        "id", has_word(F.lower("text"), v.DATE_CHANGE_WORDS).alias("asks_to_change")
    )


@query
def keyword_guards(spark: SparkSession, folder: str) -> DataFrame:
    low = F.lower("text")
    guards = {
        "charge": v.CHARGE_PHRASES,
        "identity": v.IDENTITY_PHRASES,
        "certificate": v.CERTIFICATE_PHRASES,
        "transfer": v.TRANSFER_PHRASES,
        "access": v.ACCESS_PHRASES,
        "prepayment": v.PREPAYMENT_PHRASES,
        "receipt": v.RECEIPT_WORDS,
    }
    texts = samples.conversation_messages(spark, folder)
    return texts.select(
        "id", *[contains_any(low, words).alias(name) for name, words in guards.items()]
    )


@query
def discard_rule(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("id", "only_noise")


@query
def prepayment_guard(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("id", "policy_refs", "usable_refs")


@query
def policy_grounding(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("id", "grounded")


@query
def render_reply(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("id", "answering_refs", "reply")


# Whole batch


@query
def triage_results(spark: SparkSession, folder: str) -> DataFrame:
    return flat(results(spark, folder))


@query
def triage_error_rows(spark: SparkSession, folder: str) -> DataFrame:
    return flat(results(spark, folder)).where("technical_status = 'error'")


@query
def triage_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rules.value_counts(results(spark, folder))


@query
def triage_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = rules.summarize(results(spark, folder))
    return summary.withColumns(
        {f"by_{name}": F.to_json(f"by_{name}") for name in rules.COUNTED}
    )


@query
def dq_policy_refs(spark: SparkSession, folder: str) -> DataFrame:
    return rules.uncovered_refs(samples.decisions(spark, folder), BOOK)


@query
def dq_triage_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """The results with the queue of some rows falsified."""
    rows = results(spark, folder)
    falsified = F.col("id").endswith("-2")
    return rules.broken_invariants(
        rows.withColumn("queue", F.when(falsified, "cx").otherwise(F.col("queue")))
    )
