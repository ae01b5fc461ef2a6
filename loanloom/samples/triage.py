"""Messages and decisions derived from the conversations table, and reply texts."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.plans import triage_vocabulary as v
from loanloom.plans.triage import Policy, ReplyBook

BOOK = ReplyBook(
    policies=(
        Policy("fecha_de_pago", "pagos#fechas", "Tu fecha figura en el plan de pagos."),
        Policy("metodos_de_pago", "pagos#medios", "Aceptamos tarjeta, PSE y efectivo."),
        Policy("metodos_de_pago", "pagos#anticipado", "Abonar antes no tiene costo."),
        Policy("mora_intereses", "mora#intereses", "La mora cuenta por cada día tarde."),
        Policy("reporte_centrales", "mora#centrales", "El reporte cambia al ponerse al día."),
        Policy("cuenta_y_app", "cuenta#codigo", "Pide un código nuevo tras un minuto."),
        Policy("cuenta_y_app", "cuenta#bloqueo", "El bloqueo termina en media hora."),
        Policy("cuenta_y_app", "cuenta#app", "Instala la última versión."),
        Policy("datos_personales", "datos#contacto", "Edita tus datos en tu perfil."),
        Policy("certificados_extractos", "datos#certificados", "Descárgalo en la app."),
        Policy("certificados_extractos", "mora#paz-y-salvo", "Se emite al terminar."),
    ),
    prepayment_ref="pagos#anticipado",
    receipt_ref="pagos#medios",
    receipt_reply="Adjunta el recibo y lo revisamos en un día.",
)
UNKNOWN_REF = "otros#nada"

# At least one hit per phrase list, and near misses.
PHRASES = (
    "¿Puedo cambiar la fecha?",
    "¿Por qué me cambiaron la fecha?",
    "Quiero mover mi cuota",
    "Dime por qué me cobraron más",
    "Veo un COBRO EXTRA este mes",
    "Ahora vivo en otra ciudad",
    "MI DIRECCIÓN ES OTRA",
    "Necesito un certificado de saldo",
    "El extracto no me llegó",
    "Mándame el link de pago",
    "Hago una transferencia mañana",
    "Olvidé mi contraseña",
    "Ya intenté entrar",
    "¿Puedo adelantar cuotas?",
    "Quiero pagar la totalidad",
    "Les envío el comprobante",
    "Mi correo es otro",
    "Gracias por todo",
    "¿Van a remodificar algo?",
    "Hay que ajustar: la fecha",
    "Prefiero pagar antes",
    "Buenos días",
)


def conversation_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Valid messages with their (conv_id, turn): one per turn."""
    c, t = F.col("conv_id"), F.col("turn")
    phrase = F.element_at(
        F.array(*[F.lit(p) for p in PHRASES]), ((c * 3 + t) % len(PHRASES) + 1).cast("int")
    )
    channel = F.element_at(
        F.array(*[F.lit(x) for x in v.CHANNELS]), ((c + t) % 3 + 1).cast("int")
    )
    moment = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), c.cast("int"), t.cast("int")
    )
    return (
        spark.read.parquet(f"{folder}/conversations.parquet")
        .select(
            "conv_id",
            "turn",
            F.concat(F.lit("MSG-"), c.cast("string"), F.lit("-"), t.cast("string")).alias("id"),
            channel.alias("channel"),
            F.replace(moment.cast("string"), F.lit(" "), F.lit("T")).alias("received_at"),
            F.concat(F.lit("user_"), (c % 50).cast("string")).alias("from"),
            F.concat(F.col("text"), F.lit(" "), phrase).alias("text"),
        )
    )


def message_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The messages as JSON lines, some broken by ``conv_id % 25``."""
    rows = conversation_messages(spark, folder)
    kind = F.col("conv_id") % 25
    names = ["id", "channel", "received_at", "from", "text"]
    plain = F.to_json(F.struct(*names))

    def changed(name: str, value: Column) -> Column:
        return F.to_json(
            F.struct(*[value.alias(n) if n == name else F.col(n) for n in names])
        )

    line = (
        F.when(kind == 0, F.concat(F.lit("{"), plain))
        .when(kind == 1, F.to_json(F.struct(*names, F.lit("x").alias("extra"))))
        .when(kind == 2, changed("text", F.lit(" \t \n")))
        .when(kind == 3, changed("channel", F.lit("fax")))
        .when(kind == 5, changed("received_at", F.lit("ayer")))
        .when(kind == 6, changed("id", F.col("conv_id")))
        .otherwise(plain)
    )
    copies = F.when(kind == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", line.alias("value"), F.explode(copies).alias("copy"))


def _pick(values, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (at % len(values) + 1).cast("int"))


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """A proposed decision per message as typed columns.

    By ``conv_id % 30``: 0 has an unknown reason, 1 a scorer error, 2 no decision
    and 3 an unknown policy ref.
    """
    c, t = F.col("conv_id"), F.col("turn")
    rows = conversation_messages(spark, folder)
    main = _pick(v.REASONS, c * 7 + t * 3)
    one, two, three = (
        _pick(v.REASONS, c * 5 + t),
        _pick(v.REASONS, c + 2 * t),
        _pick(v.REASONS, c * 3 + t),
    )
    form = (c + t) % 6
    secondary = (
        F.when(form == 2, F.array(main))
        .when(form == 3, F.array(one, main, one))
        .when(form == 4, F.array(two, three))
        .otherwise(F.array().cast("array<string>"))
    )
    first_refs = {reason: refs[0] for reason, refs in BOOK.by_reason().items()}
    own = F.coalesce(
        *[F.when(main == reason, F.lit(ref)) for reason, ref in first_refs.items()],
        F.lit("mora#centrales"),
    )
    cite = (c * 2 + t) % 5
    refs = (
        F.when(c % 30 == 3, F.array(own, F.lit(UNKNOWN_REF)))
        .when(cite == 0, F.array(own))
        .when(cite == 1, F.array(own, F.lit("mora#centrales")))
        .when(cite == 2, F.array(F.lit("pagos#anticipado"), own, F.lit("pagos#anticipado")))
        .when(cite == 3, F.array().cast("array<string>"))
        .otherwise(F.array(own, F.lit("pagos#medios"), own))
    )
    # A word from the start, the end or the middle of the text.
    words = F.split("text", " ")
    middle = F.element_at(words, F.floor((F.size(words) + 1) / 2).cast("int"))
    start = F.substring("text", 1, 5)
    word = (
        F.when(c % 3 == 1, F.substring("text", -5, 5))
        .when((c % 3 == 2) & (middle != ""), middle)
        .otherwise(start)
    )
    # Only a-z, since engines differ on the capital of ß.
    shouted = F.translate(word, ascii_lowercase, ascii_uppercase)
    empty = F.array().cast("array<string>")
    entities = F.struct(
        empty.alias("document_numbers"),
        F.array(word, F.lit("inventado-9")).alias("credit_ids"),
        empty.alias("amounts"),
        F.array(F.lit("ayer no")).alias("dates"),
        F.array(shouted, word, word).alias("references"),
    )
    broken = c % 30 == 1
    typed = {
        "main_reason": F.when(c % 30 == 0, "otra_cosa").otherwise(main),
        "secondary_intents": secondary,
        "priority": _pick(v.PRIORITIES, c + t),
        "entities": entities,
        "action": _pick((v.ANSWER, v.ANSWER, v.ESCALATE, v.DISCARD), c + F.floor(t / 2)),
        "queue": F.when((c + t) % 7 != 0, _pick(v.QUEUES, c + t)),
        "draft_reply": F.concat(F.lit("borrador "), F.col("id")),
        "policy_refs": refs,
    }
    return rows.where(c % 30 != 2).select(
        "id",
        *[F.when(~broken, value).alias(name) for name, value in typed.items()],
        F.when(broken, "TimeoutError").alias("scorer_error"),
    )


def decision_json(spark: SparkSession, folder: str) -> DataFrame:
    """The decisions as a scorer would return them: JSON text, some misshapen.

    By ``conv_id % 20``: 4 carries an extra field, 5 lacks its draft, 6 has a
    number among the entities.
    """
    names = [
        "main_reason",
        "secondary_intents",
        "priority",
        "entities",
        "action",
        "queue",
        "draft_reply",
        "policy_refs",
    ]
    rows = decisions(spark, folder).where("scorer_error is null")
    kind = F.regexp_extract("id", r"MSG-(\d+)-", 1).cast("bigint") % 20
    options = {"ignoreNullFields": "false"}
    plain = F.to_json(F.struct(*names), options)
    numbers = F.col("entities").withField("amounts", F.array(F.lit(5)))
    json = (
        F.when(kind == 4, F.to_json(F.struct(*names, F.lit(1).alias("extra")), options))
        .when(
            kind == 5,
            F.to_json(F.struct(*[n for n in names if n != "draft_reply"]), options),
        )
        .when(
            kind == 6,
            F.to_json(
                F.struct(*[numbers.alias(n) if n == "entities" else F.col(n) for n in names]),
                options,
            ),
        )
        .otherwise(plain)
    )
    return rows.select("id", json.alias("decision"))


def length_scorer() -> Callable[[str], dict]:
    """A fixed stand-in for a model: decides by the length of the text.

    The inner function carries its word lists along, so workers need no package.
    """
    reasons, priorities, actions = v.REASONS, v.PRIORITIES, v.ACTIONS
    fields = v.ENTITY_FIELDS

    def score(text: str) -> dict:
        size = len(text)
        if size % 13 == 0:
            raise TimeoutError("no answer")
        return {
            "main_reason": reasons[size % 20],
            "secondary_intents": [],
            "priority": priorities[size % 3],
            "entities": {name: [] for name in fields},
            "action": actions[size % 3],
            "queue": None,
            "draft_reply": None,
            "policy_refs": [],
        }

    return score
