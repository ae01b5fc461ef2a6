"""Message and decision records as JSON lines with closed schemas.

A line's variant schema names every field with its type, sorted by name, so one
pattern match rejects missing, extra and mistyped fields alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.instants import parse_utc
from loanloom.functions.text import is_blank
from loanloom.operators.quality import require_none
from loanloom.plans.triage_vocabulary import CHANNELS, ENTITY_FIELDS

MESSAGE_SCHEMA = (
    "id string, channel string, received_at string, `from` string, text string"
)
ENTITIES_SCHEMA = (
    "struct<" + ", ".join(f"{name}: array<string>" for name in ENTITY_FIELDS) + ">"
)
DECISION_SCHEMA = (
    "main_reason string, secondary_intents array<string>, priority string, "
    f"entities {ENTITIES_SCHEMA}, action string, queue string, draft_reply string, "
    "policy_refs array<string>"
)

_TEXTS = r"ARRAY<(STRING|VOID)>"
_TEXT_OR_NULL = r"(STRING|VOID)"


def _shape(fields: dict[str, str]) -> str:
    inside = ", ".join(f"{name}: {fields[name]}" for name in sorted(fields))
    return f"OBJECT<{inside}>"


_MESSAGE_SHAPE = _shape(
    dict.fromkeys(("id", "channel", "received_at", "from", "text"), "STRING")
)
_DECISION_SHAPE = _shape(
    {
        "main_reason": "STRING",
        "secondary_intents": _TEXTS,
        "priority": "STRING",
        "entities": _shape(dict.fromkeys(ENTITY_FIELDS, _TEXTS)),
        "action": "STRING",
        "queue": _TEXT_OR_NULL,
        "draft_reply": _TEXT_OR_NULL,
        "policy_refs": _TEXTS,
    }
)


def _has_shape(parsed: Column, shape: str) -> Column:
    found = F.schema_of_variant(parsed)
    return F.coalesce(found.rlike(f"^{shape}$"), F.lit(False))


def _fields(parsed: Column, schema: str) -> list[Column]:
    """The fields of a parsed line; one that is missing or of another type is null."""
    struct = T.DataType.fromDDL(schema)
    return [
        F.try_variant_get(parsed, f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
        for f in struct.fields
    ]


def parse_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add the message fields and ``problem``: null, or the first broken rule."""
    kept = [c for c in lines.columns if c != column]
    json = F.col("_json")
    # A line is parsed once; everything else is read off the variant.
    fields = lines.select(*kept, F.try_parse_json(column).alias("_json")).select(
        *kept, "_json", F.struct(*_fields(json, MESSAGE_SCHEMA)).alias("_m")
    )
    m = F.col("_m")
    blank = is_blank(m["id"]) | is_blank(m["from"]) | is_blank(m["text"])
    stamp = m["received_at"]
    dated = stamp.rlike(r"^\d{4}-") & parse_utc(stamp).isNotNull()
    problem = (
        F.when(json.isNull(), "json")
        .when(~_has_shape(json, _MESSAGE_SHAPE), "schema")
        .when(blank, "blank")
        .when(~m["channel"].isin(*CHANNELS), "channel")
        .when(~dated, "received_at")
    )
    return fields.withColumn("problem", problem).select(*kept, "_m.*", "problem")


def invalid_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("problem").isNotNull())


def duplicate_ids(parsed: DataFrame) -> DataFrame:
    """Ids used by more than one valid message, with their count."""
    return (
        parsed.where(F.col("problem").isNull())
        .groupBy("id")
        .agg(F.count("*").alias("n_messages"))
        .where("n_messages > 1")
    )


def require_valid(parsed: DataFrame) -> None:
    """Raises on any broken line or repeated id, both found in one aggregate.

    Broken lines are counted by their rule, so they too are combined before the shuffle.
    """
    broken = F.col("problem").isNotNull()
    require_none(
        parsed.groupBy(F.when(~broken, F.col("id")).alias("id"), "problem")
        .agg(F.count("*").alias("n_messages"), F.min("file").alias("file"))
        .where(broken | (F.col("n_messages") > 1))
        .withColumn("problem", F.coalesce("problem", F.lit("duplicate message id"))),
        "invalid message",
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a folder of JSON lines; any bad line or repeated id is an error."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    parsed = parse_messages(lines)
    require_valid(parsed)
    return parsed.select("id", "channel", "received_at", "from", "text")


def parse_decisions(records: DataFrame, column: str = "decision") -> DataFrame:
    """Replace a JSON column by typed decision fields and ``well_formed``."""
    kept = [c for c in records.columns if c != column]
    json = F.col("_json")
    return records.select(*kept, F.try_parse_json(column).alias("_json")).select(
        *kept, *_fields(json, DECISION_SCHEMA), _has_shape(json, _DECISION_SHAPE).alias("well_formed")
    )
