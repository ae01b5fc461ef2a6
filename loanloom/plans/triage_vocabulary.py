"""Closed vocabularies and phrase lists of the message triage.

Everything in this module is a fixed value: results are only right with exactly
these words. Order matters where a mapping or list is searched first to last.
"""

from __future__ import annotations

# Contact reasons.
REASONS = (
    "consulta_saldo_cuotas",
    "estado_solicitud_credito",
    "informacion_productos",
    "canales_horarios_atencion",
    "fecha_de_pago",
    "no_puede_pagar",
    "refinanciacion_acuerdo",
    "pago_no_aplicado",
    "metodos_de_pago",
    "mora_intereses",
    "reporte_centrales",
    "cuenta_y_app",
    "datos_personales",
    "certificados_extractos",
    "fraude_seguridad",
    "queja_reclamo",
    "felicitacion_feedback",
    "cancelacion",
    "hablar_con_humano",
    "fuera_de_alcance",
)

# Priorities, actions, queues, channels.
PRIORITIES = ("alta", "media", "baja")
ANSWER, ESCALATE, DISCARD = "responder_automaticamente", "escalar_humano", "descartar"
ACTIONS = (ANSWER, ESCALATE, DISCARD)
QUEUES = ("cartera", "pagos", "fraude", "soporte", "legal", "cx")
CHANNELS = ("chat", "email", "whatsapp")
ENTITY_FIELDS = ("document_numbers", "credit_ids", "amounts", "dates", "references")

# Reasons that always need a person, most urgent first, with queue.
HUMAN_QUEUES = {
    "fraude_seguridad": "fraude",
    "pago_no_aplicado": "pagos",
    "no_puede_pagar": "cartera",
    "refinanciacion_acuerdo": "cartera",
    "queja_reclamo": "legal",
    "estado_solicitud_credito": "cx",
    "informacion_productos": "cx",
    "canales_horarios_atencion": "cx",
    "cancelacion": "cx",
    "consulta_saldo_cuotas": "cx",
    "hablar_con_humano": "cx",
}
FALLBACK_QUEUE = "cx"

# Reasons that may be discarded.
NOISE_REASONS = ("fuera_de_alcance", "felicitacion_feedback")

# A payment-date question without one of these whole words goes to cx.
DATE_CHANGE_WORDS = ("cambiar", "mover", "modificar", "ajustar")

# Phrases that turn an answerable reason into a case for a queue.
CHARGE_PHRASES = (
    "me cobr",
    "me estan cobr",
    "me están cobr",
    "me sigue subiendo",
    "cobro extra",
    "cobro adicional",
    "me quitan",
    "cuanto me",
    "cuánto me",
)
IDENTITY_PHRASES = (
    "dirección",
    "direccion",
    "ciudad",
    "nombre",
    "nacionalidad",
    "estado civil",
)
CERTIFICATE_PHRASES = (
    "certificado de la deuda",
    "certificado de saldo",
    "certificado del saldo",
    "no me lleg",
    "reenvi",
    "retencion",
    "retención",
    "tributario",
)
TRANSFER_PHRASES = (
    "link de pago",
    "numero de cuenta",
    "número de cuenta",
    "transferencia",
)
ACCESS_PHRASES = (
    "contraseña",
    "contrasena",
    "clave",
    "ya intent",
    "ya no lo tengo",
    "ya reinici",
    "ya revis",
)

# Phrases that show the customer asked about paying early, and
# words that show a question about payment receipts.
PREPAYMENT_PHRASES = (
    "adelant",
    "anticip",
    "pagar antes",
    "pago antes",
    "totalidad",
    "todo el credito",
    "todo el crédito",
)
RECEIPT_WORDS = ("comprobante", "correo")

# Fixed value: the only text an error row may carry.
ERROR_MESSAGE = "internal processing error"
