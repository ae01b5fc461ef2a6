"""Message triage: fixed rules over scored messages, as column expressions.

A scorer proposes a decision per message; these rules decide what is safe. All of
it is one projection over messages joined with their decisions. Nothing in it is
a Python function per row except the caller's own scorer.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.lists import (
    all_within,
    distinct_without,
    evidenced,
    first_match,
    remove_first,
)
from loanloom.functions.money import ratio
from loanloom.functions.text import contains_any, has_word
from loanloom.plans import triage_vocabulary as v
from loanloom.sources.messages import DECISION_SCHEMA, ENTITIES_SCHEMA

RESULT_COLUMNS = (
    "id",
    "technical_status",
    "main_reason",
    "secondary_intents",
    "priority",
    "entities",
    "action",
    "queue",
    "draft_reply",
    "policy_refs",
    "error",
)


class Policy(NamedTuple):
    """A reviewed reply that one policy section gives for one reason."""

    reason: str
    ref: str
    reply: str


@dataclass(frozen=True)
class ReplyBook:
    """The reviewed replies, at most a few hundred, and two special sections.

    ``prepayment_ref`` only counts when the customer asks about paying early.
    ``receipt_ref`` answers receipt questions with ``receipt_reply``.
    """

    policies: tuple[Policy, ...]
    prepayment_ref: str
    receipt_ref: str
    receipt_reply: str

    def __post_init__(self) -> None:
        if len({p.ref for p in self.policies}) != len(self.policies):
            raise ValueError("each policy section must belong to one reason")

    @property
    def refs(self) -> list[str]:
        return [p.ref for p in self.policies]

    def by_reason(self) -> dict[str, list[str]]:
        grouped: dict[str, list[str]] = {}
        for policy in self.policies:
            grouped.setdefault(policy.reason, []).append(policy.ref)
        return grouped


def _texts(values) -> Column:
    return F.array(*[F.lit(value) for value in values]).cast("array<string>")


# Scoring


def score_messages(messages: DataFrame, scorer: Callable[[str], dict]) -> DataFrame:
    """The messages with ``decision`` as JSON and ``scorer_error``.

    Only the text reaches the Python workers, so sender data never leaves, and what they
    return stays beside its message: nothing is joined. A scorer that raises costs one
    row, and only its exception's type is kept.
    """
    return messages.select(
        "*", scored_text(F.col("text"), scorer).alias("_scored")
    ).select(*messages.columns, "_scored.*")


def scored_text(text: Column, scorer: Callable[[str], dict]) -> Column:
    """``decision`` and ``scorer_error`` of each text.

    A scorer may answer differently each time, so Spark must neither call it twice nor
    move it past a filter.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            decisions: list[str | None] = []
            errors: list[str | None] = []
            for value in batch.to_pylist():
                try:
                    decisions.append(json.dumps(scorer(value), ensure_ascii=False))
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001
                    decisions.append(None)
                    errors.append(type(exc).__name__)
            columns = [pa.array(decisions, pa.string()), pa.array(errors, pa.string())]
            yield pa.StructArray.from_arrays(columns, ["decision", "scorer_error"])

    # Spark reads the kind of function off these.
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    scored = F.arrow_udf(run, "decision string, scorer_error string")
    return scored.asNondeterministic()(text)


# Validity


def decision_problems(book: ReplyBook) -> Column:
    """Names of the decision fields that break the closed schema."""

    def closed(name: str, values) -> Column:
        return F.when(
            F.col(name).isNull() | ~F.col(name).isin(*values), F.lit(name)
        )

    def closed_list(name: str, values) -> Column:
        fine = F.coalesce(all_within(F.col(name), _texts(values)), F.lit(False))
        return F.when(~fine, F.lit(name))

    complete = F.lit(True)
    for name in v.ENTITY_FIELDS:
        values = F.col("entities")[name]
        without_nulls = F.size(F.array_compact(values)) == F.size(values)
        complete = complete & F.coalesce(without_nulls, F.lit(False))
    return F.array_compact(
        F.array(
            F.when(~F.coalesce("well_formed", F.lit(True)), F.lit("schema")),
            closed("main_reason", v.REASONS),
            closed_list("secondary_intents", v.REASONS),
            closed("priority", v.PRIORITIES),
            F.when(~complete, F.lit("entities")),
            closed("action", v.ACTIONS),
            F.when(
                F.col("queue").isNotNull() & ~F.col("queue").isin(*v.QUEUES),
                F.lit("queue"),
            ),
            closed_list("policy_refs", book.refs),
        )
    )


# Rules


def all_intents(main: Column, secondary: Column) -> Column:
    """Main reason first, then the distinct other intents in order."""
    return F.concat(F.array(main), distinct_without(secondary, main))


def human_queue(intents: Column) -> Column:
    """Queue of the most urgent intent that always needs a person, else null."""
    return first_match(intents, v.HUMAN_QUEUES)


def contextual_queue(intents: Column, text: Column) -> Column:
    """Queue for answerable topics whose wording needs a person; first rule wins."""

    def about(reason: str) -> Column:
        return F.array_contains(intents, reason)

    rules = (
        (about("fecha_de_pago") & ~has_word(text, v.DATE_CHANGE_WORDS), "cx"),
        (about("mora_intereses") & contains_any(text, v.CHARGE_PHRASES), "cartera"),
        (about("datos_personales") & contains_any(text, v.IDENTITY_PHRASES), "soporte"),
        (
            about("certificados_extractos")
            & contains_any(text, v.CERTIFICATE_PHRASES),
            "cx",
        ),
        (about("metodos_de_pago") & contains_any(text, v.TRANSFER_PHRASES), "cx"),
        (about("cuenta_y_app") & contains_any(text, v.ACCESS_PHRASES), "soporte"),
    )
    return F.coalesce(*[F.when(rule, F.lit(queue)) for rule, queue in rules])


def only_noise(intents: Column) -> Column:
    return all_within(intents, _texts(v.NOISE_REASONS))


def usable_refs(refs: Column, text: Column, book: ReplyBook) -> Column:
    """Cited refs, less the first prepayment one unless the text asks about it."""
    asked = contains_any(text, v.PREPAYMENT_PHRASES)
    return F.when(asked, refs).otherwise(remove_first(refs, book.prepayment_ref))


def grounded(intents: Column, refs: Column, book: ReplyBook) -> Column:
    """True when every intent has a cited ref of its own."""
    covered = [
        F.when(F.arrays_overlap(refs, _texts(own)), F.lit(reason))
        for reason, own in book.by_reason().items()
    ]
    return all_within(intents, F.array_compact(F.array(*covered)))


def answering_refs(
    intents: Column, refs: Column, text: Column, book: ReplyBook
) -> Column:
    """Distinct cited refs that answer an intent, in citation order."""
    owned = [
        F.when(F.array_contains(intents, p.reason), F.lit(p.ref)) for p in book.policies
    ]
    receipt = F.when(contains_any(text, v.RECEIPT_WORDS), F.lit(book.receipt_ref))
    return F.array_intersect(refs, F.array_compact(F.array(*owned, receipt)))


def reply_text(refs: Column, text: Column, book: ReplyBook) -> Column:
    """Reviewed replies of the refs, joined by a space."""
    pairs = [F.lit(part) for p in book.policies for part in (p.ref, p.reply)]
    replies = F.create_map(*pairs)
    receipt = contains_any(text, v.RECEIPT_WORDS)
    return F.array_join(
        F.transform(
            refs,
            lambda ref: F.when(
                (ref == book.receipt_ref) & receipt, F.lit(book.receipt_reply)
            ).otherwise(F.try_element_at(replies, ref)),
        ),
        " ",
    )


def rule_columns(scored: DataFrame, book: ReplyBook) -> DataFrame:
    """Add every rule's outcome to messages that carry a decision."""
    low = F.col("_low")
    intents = F.col("intents")
    usable = F.col("usable_refs")
    return (
        scored.withColumns(
            {
                "_low": F.lower("text"),
                "intents": all_intents(F.col("main_reason"), F.col("secondary_intents")),
            }
        )
        .withColumns(
            {
                "human_queue": human_queue(intents),
                "contextual_queue": contextual_queue(intents, low),
                "only_noise": only_noise(intents),
                "usable_refs": usable_refs(F.col("policy_refs"), low, book),
                "evidence": F.struct(
                    *[
                        evidenced(F.col("entities")[name], low).alias(name)
                        for name in v.ENTITY_FIELDS
                    ]
                ),
            }
        )
        .withColumns(
            {
                "grounded": grounded(intents, usable, book),
                "answering_refs": answering_refs(intents, usable, low, book),
            }
        )
        .withColumn("reply", reply_text(F.col("answering_refs"), low, book))
    )


def triage(messages: DataFrame, decisions: DataFrame, book: ReplyBook) -> DataFrame:
    """One result row per message, plus ``received_at`` for ordering.

    ``decisions`` has one row per message id. A message whose scorer failed, whose
    decision breaks the schema or that has no decision becomes an error row.
    """
    extras = {
        name: F.lit(None).cast(kind)
        for name, kind in (("scorer_error", "string"), ("well_formed", "boolean"))
        if name not in decisions.columns
    }
    fields = T.DataType.fromDDL(DECISION_SCHEMA).fieldNames()
    known = {"id", *fields, "scorer_error", "well_formed"}
    named = decisions.select(*[c for c in decisions.columns if c in known])
    proposed = named.withColumns({**extras, "_scored": F.lit(True)})
    scored = messages.select("id", "received_at", "text").join(proposed, "id", "left")
    return triage_decided(scored, book)


def triage_decided(scored: DataFrame, book: ReplyBook) -> DataFrame:
    """``triage`` of messages that stand beside their decision already."""
    if "_scored" not in scored.columns:
        scored = scored.withColumn("_scored", F.lit(True))
    failure = (
        F.when(F.col("_scored").isNull(), "ValueError")
        .when(F.col("scorer_error").isNotNull(), F.col("scorer_error"))
        .when(F.size(decision_problems(book)) > 0, "ValidationError")
    )
    ruled = rule_columns(scored.withColumn("_failure", failure), book)

    proposal = F.col("action")
    branch = (
        F.when(F.col("human_queue").isNotNull(), "person")
        .when(F.col("contextual_queue").isNotNull(), "context")
        .when(F.col("only_noise"), "noise")
        .when(proposal == v.DISCARD, "rescued")
        .when((proposal == v.ANSWER) & F.col("grounded"), "answer")
        .when(proposal == v.ANSWER, "ungrounded")
        .otherwise("proposed")
    )
    took = F.col("_branch")
    action = (
        F.when(took == "noise", v.DISCARD)
        .when(took == "answer", v.ANSWER)
        .otherwise(v.ESCALATE)
    )
    queue = (
        F.when(took == "person", F.col("human_queue"))
        .when(took == "context", F.col("contextual_queue"))
        .when(took.isin("rescued", "ungrounded"), v.FALLBACK_QUEUE)
        .when(took == "proposed", F.coalesce("queue", F.lit(v.FALLBACK_QUEUE)))
    )
    priority = (
        F.when(F.array_contains("intents", "fraude_seguridad"), "alta")
        .when(took == "noise", "baja")
        .otherwise(F.col("priority"))
    )
    answered = took == "answer"
    none = F.array().cast("array<string>")
    no_entities = F.struct(*[none.alias(name) for name in v.ENTITY_FIELDS]).cast(
        ENTITIES_SCHEMA
    )
    ok = F.col("_failure").isNull()

    def if_ok(value: Column, otherwise: Column | None = None) -> Column:
        return F.when(ok, value) if otherwise is None else F.when(ok, value).otherwise(otherwise)

    return ruled.withColumn("_branch", branch).select(
        "id",
        F.when(ok, "ok").otherwise("error").alias("technical_status"),
        if_ok(F.col("main_reason")).alias("main_reason"),
        if_ok(F.slice("intents", F.lit(2), F.size("intents")), none).alias(
            "secondary_intents"
        ),
        if_ok(priority).alias("priority"),
        F.when(ok & (took != "noise"), F.col("evidence").cast(ENTITIES_SCHEMA))
        .otherwise(no_entities)
        .alias("entities"),
        if_ok(action).alias("action"),
        if_ok(queue).alias("queue"),
        F.when(ok & answered, F.col("reply")).alias("draft_reply"),
        F.when(ok & answered, F.col("answering_refs")).otherwise(none).alias("policy_refs"),
        F.when(
            ~ok,
            F.struct(
                F.col("_failure").alias("type"), F.lit(v.ERROR_MESSAGE).alias("message")
            ),
        ).alias("error"),
        "received_at",
    )


# Summary

COUNTED = ("main_reason", "priority", "action", "queue")


def _field_counts(results: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    pairs = [
        F.struct(F.lit(name).alias("field"), F.col(name).alias("value"))
        for name in fields
    ]
    return (
        results.select(F.inline(F.array(*pairs)))
        .where("value is not null")
        .groupBy("field", "value")
        .agg(F.count("*").alias("n"))
    )


def value_counts(results: DataFrame) -> DataFrame:
    """(field, value, n) in one pass; nulls, hence error rows, are skipped."""
    return _field_counts(results, COUNTED)


def summarize(results: DataFrame) -> DataFrame:
    """One row: totals, counts per field as sorted maps, share answerable.

    Everything is read off the per-field counts. The closed vocabularies bound
    those to a few dozen rows, so the maps stay small at any batch size.
    """
    counts = _field_counts(results, ("technical_status", *COUNTED))
    field, value, n = F.col("field"), F.col("value"), F.col("n")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    status = field == "technical_status"
    maps = [
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(field == name, F.struct(value, n))))
        ).alias(f"by_{name}")
        for name in COUNTED
    ]
    return counts.agg(
        total(status).alias("total_messages"),
        total(status & (value == "ok")).alias("business_results"),
        total(status & (value == "error")).alias("technical_errors"),
        *maps,
        total((field == "action") & (value == v.ANSWER)).alias("auto_answerable"),
    ).withColumn(
        "auto_answerable_ratio",
        ratio(F.col("auto_answerable"), F.col("business_results")),
    )


# Checks


def uncovered_refs(decisions: DataFrame, book: ReplyBook) -> DataFrame:
    """Cited refs that no policy has."""
    cited = decisions.select("id", F.explode("policy_refs").alias("policy_ref"))
    return cited.where(~F.col("policy_ref").isin(*book.refs)).distinct()


def broken_invariants(results: DataFrame) -> DataFrame:
    """(id, rule) for result rows whose fields contradict their action."""
    action = F.col("action")
    names = [F.col("entities")[name] for name in v.ENTITY_FIELDS]
    n_entities = sum((F.size(name) for name in names), F.lit(0))
    errored = F.col("technical_status") == "error"
    rules = {
        "queue_without_escalation": F.col("queue").isNotNull()
        & ~F.coalesce(action == v.ESCALATE, F.lit(False)),
        "escalation_without_queue": (action == v.ESCALATE) & F.col("queue").isNull(),
        "reply_without_answer": (
            F.col("draft_reply").isNotNull() | (F.size("policy_refs") > 0)
        )
        & ~F.coalesce(action == v.ANSWER, F.lit(False)),
        "answer_without_reply": (action == v.ANSWER)
        & (F.col("draft_reply").isNull() | (F.size("policy_refs") == 0)),
        "entities_in_discard": (action == v.DISCARD) & (n_entities > 0),
        "error_with_result": errored & (action.isNotNull() | F.col("main_reason").isNotNull()),
        "status_without_error": errored != F.col("error").isNotNull(),
    }
    found = F.array_compact(
        F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()])
    )
    return results.select("id", F.explode(found).alias("rule"))
