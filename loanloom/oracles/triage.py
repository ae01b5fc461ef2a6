"""Expected triage results in SQL, on one row per intent, ref or phrase."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from loanloom.plans import triage_vocabulary as v
from loanloom.samples.triage import BOOK, PHRASES, UNKNOWN_REF


def _list(values) -> str:
    return "[" + ", ".join(f"'{x}'" for x in values) + "]"


def _pick(values, at: str) -> str:
    return f"({_list(values)})[CAST(({at}) % {len(values)} AS INTEGER) + 1]"


def _rows(*rows) -> str:
    return ", ".join(
        "(" + ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in row) + ")"
        for row in rows
    )


def _any(text: str, phrases) -> str:
    return f"len(list_filter({_list(phrases)}, lambda p: position(p IN {text}) > 0)) > 0"


_WORDS = "|".join(v.DATE_CHANGE_WORDS)
_EDGE = r"[^\p{L}\p{M}\p{N}_]"
_WHOLE_WORD = f"regexp_matches(low, '(^|{_EDGE})({_WORDS})($|{_EDGE})')"

_FIRST_REF = {reason: refs[0] for reason, refs in BOOK.by_reason().items()}

# (order, reason, queue, phrase): the first order with a hit wins.
_CONTEXT = [
    (order, reason, queue, phrase)
    for order, reason, queue, phrases in (
        (2, "mora_intereses", "cartera", v.CHARGE_PHRASES),
        (3, "datos_personales", "soporte", v.IDENTITY_PHRASES),
        (4, "certificados_extractos", "cx", v.CERTIFICATE_PHRASES),
        (5, "metodos_de_pago", "cx", v.TRANSFER_PHRASES),
        (6, "cuenta_y_app", "soporte", v.ACCESS_PHRASES),
    )
    for phrase in phrases
]

_JOINED = "coalesce(string_agg({0}, '|' ORDER BY {1}), '')"

TRIAGE_CTES: dict[str, str] = {
    "m_messages": f"""
        SELECT conv_id AS c, turn AS t, 'MSG-' || conv_id || '-' || turn AS id,
               text || ' ' || {_pick(PHRASES, 'conv_id * 3 + turn')} AS body,
               lower(text || ' ' || {_pick(PHRASES, 'conv_id * 3 + turn')}) AS low
        FROM conversations""",
    "m_decisions": f"""
        SELECT c, t, id, body, low, main, secondary,
               {_pick(v.PRIORITIES, 'c + t')} AS priority,
               {_pick((v.ANSWER, v.ANSWER, v.ESCALATE, v.DISCARD), 'c + t // 2')} AS action,
               CASE WHEN (c + t) % 7 <> 0 THEN {_pick(v.QUEUES, 'c + t')} END AS queue,
               CASE WHEN c % 30 = 3 THEN [own, '{UNKNOWN_REF}']
                    WHEN (c * 2 + t) % 5 = 0 THEN [own]
                    WHEN (c * 2 + t) % 5 = 1 THEN [own, 'mora#centrales']
                    WHEN (c * 2 + t) % 5 = 2 THEN ['pagos#anticipado', own, 'pagos#anticipado']
                    WHEN (c * 2 + t) % 5 = 3 THEN []
                    ELSE [own, 'pagos#medios', own] END AS refs
        FROM (SELECT *, coalesce((SELECT ref FROM (VALUES {_rows(*_FIRST_REF.items())}) f(r, ref)
                                  WHERE r = main), 'mora#centrales') AS own
              FROM (SELECT *, {_pick(v.REASONS, 'c * 7 + t * 3')} AS main,
                    CASE (c + t) % 6
                        WHEN 2 THEN [{_pick(v.REASONS, 'c * 7 + t * 3')}]
                        WHEN 3 THEN [{_pick(v.REASONS, 'c * 5 + t')},
                                     {_pick(v.REASONS, 'c * 7 + t * 3')},
                                     {_pick(v.REASONS, 'c * 5 + t')}]
                        WHEN 4 THEN [{_pick(v.REASONS, 'c + 2 * t')},
                                     {_pick(v.REASONS, 'c * 3 + t')}]
                        ELSE [] END AS secondary
                    FROM m_messages))""",
    "m_valid": "SELECT * FROM m_decisions WHERE c % 30 NOT IN (0, 1, 2, 3)",
    "m_intents": """
        SELECT id, 0 AS pos, main AS reason FROM m_valid
        UNION ALL
        SELECT id, min(pos), reason FROM (
            SELECT id, main, unnest(secondary) AS reason,
                   generate_subscripts(secondary, 1) AS pos FROM m_valid)
        WHERE reason <> main GROUP BY id, reason""",
    "m_worded": """
        SELECT *, CASE WHEN c % 3 = 1 THEN right(body, 5)
                       WHEN c % 3 = 2 AND split_part(body, ' ', (pieces + 1) // 2) <> ''
                       THEN split_part(body, ' ', (pieces + 1) // 2)
                       ELSE substring(body, 1, 5) END AS word
        FROM (SELECT *, CAST(len(string_split(body, ' ')) AS INTEGER) AS pieces FROM m_valid)""",
    "m_entities": f"""
        SELECT id, field, min(pos) AS pos, value FROM (
            SELECT id, low, 'credit_ids' AS field,
                   unnest([word, 'inventado-9']) AS value,
                   unnest([1, 2]) AS pos FROM m_worded
            UNION ALL
            SELECT id, low, 'dates', 'ayer no', 1 FROM m_valid
            UNION ALL
            SELECT id, low, 'references',
                   unnest([translate(word, '{ascii_lowercase}',
                                     '{ascii_uppercase}'),
                           word, word]), unnest([1, 2, 3]) FROM m_worded)
        WHERE position(lower(value) IN low) > 0 GROUP BY id, field, value""",
    "m_evidence": f"""
        SELECT id, '' AS document_numbers, '' AS amounts,
               coalesce(string_agg(value, '|' ORDER BY pos) FILTER (field = 'credit_ids'), '')
                   AS credit_ids,
               coalesce(string_agg(value, '|' ORDER BY pos) FILTER (field = 'dates'), '') AS dates,
               coalesce(string_agg(value, '|' ORDER BY pos) FILTER (field = 'references'), '')
                   AS "references"
        FROM m_valid LEFT JOIN m_entities USING (id) GROUP BY id""",
    "m_human": f"""
        SELECT m.id, arg_min(x.queue, x.ord) AS human_queue
        FROM m_valid m LEFT JOIN (
            SELECT i.id, h.ord, h.queue FROM m_intents i
            JOIN (VALUES {_rows(*[(n, r, q) for n, (r, q) in enumerate(v.HUMAN_QUEUES.items())])})
                 h(ord, reason, queue) USING (reason)) x USING (id)
        GROUP BY m.id""",
    "m_context": f"""
        SELECT m.id, arg_min(x.queue, x.ord) AS contextual_queue
        FROM m_valid m LEFT JOIN (
            SELECT i.id, k.ord, k.queue FROM m_intents i JOIN m_valid d USING (id)
            JOIN (VALUES {_rows(*_CONTEXT)}) k(ord, reason, queue, phrase)
              ON k.reason = i.reason AND position(k.phrase IN d.low) > 0
            UNION ALL
            SELECT i.id, 1, 'cx' FROM m_intents i JOIN m_valid d USING (id)
            WHERE i.reason = 'fecha_de_pago' AND NOT {_WHOLE_WORD}) x USING (id)
        GROUP BY m.id""",
    "m_noise": f"""
        SELECT id, bool_and(list_contains({_list(v.NOISE_REASONS)}, reason)) AS only_noise
        FROM m_intents GROUP BY id""",
    "m_refs": f"""
        SELECT id, pos, ref FROM (
            SELECT id, low, unnest(refs) AS ref, generate_subscripts(refs, 1) AS pos,
                   list_position(refs, '{BOOK.prepayment_ref}') AS first_pos FROM m_valid)
        WHERE pos IS DISTINCT FROM first_pos OR {_any('low', v.PREPAYMENT_PHRASES)}""",
    "m_policies": f"SELECT * FROM (VALUES {_rows(*BOOK.policies)}) p(reason, ref, reply)",
    "m_grounded": """
        SELECT id, bool_and(has_ref) AS grounded FROM (
            SELECT i.id, i.reason, count(r.ref) > 0 AS has_ref
            FROM m_intents i LEFT JOIN m_policies p USING (reason)
            LEFT JOIN m_refs r ON r.id = i.id AND r.ref = p.ref GROUP BY i.id, i.reason)
        GROUP BY id""",
    "m_replies": f"""
        SELECT m.id, {_JOINED.format('x.ref', 'x.pos')} AS answering_refs,
               coalesce(string_agg(x.reply, ' ' ORDER BY x.pos), '') AS reply
        FROM m_valid m LEFT JOIN (
            SELECT r.id, r.ref, min(r.pos) AS pos,
                   CASE WHEN r.ref = '{BOOK.receipt_ref}' AND d.receipt THEN '{BOOK.receipt_reply}'
                        ELSE p.reply END AS reply
            FROM m_refs r
            JOIN (SELECT id, {_any('low', v.RECEIPT_WORDS)} AS receipt FROM m_valid) d USING (id)
            JOIN m_policies p ON p.ref = r.ref
            WHERE EXISTS (SELECT 1 FROM m_intents i WHERE i.id = r.id AND i.reason = p.reason)
               OR (r.ref = '{BOOK.receipt_ref}' AND d.receipt)
            GROUP BY r.id, r.ref, d.receipt, p.reply) x USING (id)
        GROUP BY m.id""",
    "m_branch": f"""
        SELECT d.*, human_queue, contextual_queue, answering_refs, reply,
               CASE WHEN human_queue IS NOT NULL THEN 1 WHEN contextual_queue IS NOT NULL THEN 2
                    WHEN only_noise THEN 3 WHEN action = '{v.DISCARD}' THEN 4
                    WHEN action = '{v.ANSWER}' AND grounded THEN 5
                    WHEN action = '{v.ANSWER}' THEN 6 ELSE 7 END AS branch
        FROM m_valid d JOIN m_human USING (id) JOIN m_context USING (id) JOIN m_noise USING (id)
        JOIN m_grounded USING (id) JOIN m_replies USING (id)""",
    "m_results": f"""
        SELECT b.id, 'ok' AS technical_status, b.main AS main_reason,
               (SELECT {_JOINED.format('reason', 'pos')} FROM m_intents i
                WHERE i.id = b.id AND pos > 0) AS secondary_intents,
               CASE WHEN EXISTS (SELECT 1 FROM m_intents i
                                 WHERE i.id = b.id AND reason = 'fraude_seguridad') THEN 'alta'
                    WHEN branch = 3 THEN 'baja' ELSE priority END AS priority,
               CASE branch WHEN 3 THEN '{v.DISCARD}' WHEN 5 THEN '{v.ANSWER}'
                    ELSE '{v.ESCALATE}' END AS action,
               CASE branch WHEN 1 THEN human_queue WHEN 2 THEN contextual_queue WHEN 4 THEN 'cx'
                    WHEN 6 THEN 'cx' WHEN 7 THEN coalesce(queue, 'cx') END AS queue,
               CASE WHEN branch = 5 THEN reply END AS draft_reply,
               CASE WHEN branch = 5 THEN answering_refs ELSE '' END AS policy_refs,
               '' AS document_numbers,
               CASE WHEN branch = 3 THEN '' ELSE e.credit_ids END AS credit_ids, '' AS amounts,
               CASE WHEN branch = 3 THEN '' ELSE e.dates END AS dates,
               CASE WHEN branch = 3 THEN '' ELSE e."references" END AS "references",
               CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS error_message
        FROM m_branch b JOIN m_evidence e USING (id)
        UNION ALL
        SELECT id, 'error', NULL, '', NULL, NULL, NULL, NULL, '', '', '', '', '', '',
               CASE c % 30 WHEN 1 THEN 'TimeoutError' WHEN 2 THEN 'ValueError'
                    ELSE 'ValidationError' END, '{v.ERROR_MESSAGE}'
        FROM m_messages WHERE c % 30 IN (0, 1, 2, 3)""",
    "m_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS field, {name} AS value, count(*) AS n FROM m_results "
        f"WHERE technical_status = 'ok' AND {name} IS NOT NULL GROUP BY {name}"
        for name in ("main_reason", "priority", "action", "queue")
    ),
}


def _map(name: str) -> str:
    return (
        "(SELECT '{' || coalesce(string_agg('\"' || value || '\":' || n, ',' ORDER BY value), '') "
        f"|| '}}' FROM m_counts WHERE field = '{name}')"
    )


_KIND = "c % 20"

TRIAGE_SQL: dict[str, str] = {
    "messages_invalid_rows": """
        SELECT c AS conv_id, t AS turn,
               CASE c % 25 WHEN 0 THEN 'json' WHEN 1 THEN 'schema' WHEN 2 THEN 'blank'
                    WHEN 3 THEN 'channel' WHEN 5 THEN 'received_at' ELSE 'schema' END AS problem
        FROM m_messages WHERE c % 25 IN (0, 1, 2, 3, 5, 6)""",
    "messages_duplicate_ids": """
        SELECT id, CAST(2 AS BIGINT) AS n_messages FROM m_messages WHERE c % 25 = 4""",
    "decisions_invalid_rows": f"""
        SELECT id, array_to_string(list_filter([
                   CASE WHEN {_KIND} IN (4, 5, 6) THEN 'schema' END,
                   CASE WHEN c % 30 = 0 THEN 'main_reason' END,
                   CASE WHEN c % 30 = 3 THEN 'policy_refs' END], lambda x: x IS NOT NULL), '|')
                   AS problems
        FROM m_messages
        WHERE c % 30 NOT IN (1, 2) AND ({_KIND} IN (4, 5, 6) OR c % 30 IN (0, 3))""",
    "triage_json_roundtrip": "SELECT * FROM m_results",
    "report_positions": """
        SELECT id, row_number() OVER (ORDER BY moment, id) AS position,
               strftime(moment, '%Y-%m-%dT%H:%M:%S') AS received_at
        FROM (SELECT id, TIMESTAMP '2024-01-01' + to_hours(c) + to_minutes(t) AS moment
              FROM m_messages)""",
    "triage_report": """
        SELECT count(*) AS message_count, true AS complete, count(*) AS total_messages,
               count(*) FILTER (length(body) % 13 > 0) AS business_results,
               count(*) FILTER (length(body) % 13 = 0) AS technical_errors
        FROM m_messages""",
    "scored_messages": f"""
        SELECT id, CASE WHEN n % 13 = 0 THEN 'error' ELSE 'ok' END AS technical_status,
               CASE WHEN n % 13 > 0 THEN main END AS main_reason,
               CASE WHEN n % 13 = 0 THEN NULL WHEN main = 'fraude_seguridad' THEN 'alta'
                    WHEN kind = 3 THEN 'baja' ELSE {_pick(v.PRIORITIES, 'n')} END AS priority,
               CASE WHEN n % 13 = 0 THEN NULL WHEN kind = 3 THEN '{v.DISCARD}'
                    ELSE '{v.ESCALATE}' END AS action,
               CASE WHEN n % 13 = 0 OR kind = 3 THEN NULL ELSE coalesce(human, context, 'cx') END
                   AS queue,
               CASE WHEN n % 13 = 0 THEN 'TimeoutError' END AS error_type
        FROM (SELECT *, CASE WHEN human IS NULL AND context IS NULL
                             AND list_contains({_list(v.NOISE_REASONS)}, main) THEN 3 ELSE 0 END
                     AS kind
              FROM (SELECT id, n, main,
                    (SELECT queue FROM (VALUES {_rows(*v.HUMAN_QUEUES.items())}) h(r, queue)
                     WHERE r = main) AS human,
                    CASE WHEN main = 'fecha_de_pago' AND NOT {_WHOLE_WORD} THEN 'cx'
                         ELSE (SELECT min(queue) FROM (VALUES {_rows(*_CONTEXT)})
                                   k(ord, reason, queue, phrase)
                               WHERE k.reason = main AND position(k.phrase IN low) > 0)
                    END AS context
                    FROM (SELECT id, low, length(body) AS n,
                                 {_pick(v.REASONS, 'length(body)')} AS main FROM m_messages)))""",
    "array_dedup_ordered": """
        SELECT id, string_agg(reason, '|' ORDER BY pos) AS intents FROM m_intents GROUP BY id""",
    "entity_evidence": "SELECT * FROM m_evidence",
    "priority_match": "SELECT id, human_queue FROM m_human",
    "contextual_queue": "SELECT id, contextual_queue FROM m_context",
    "keyword_whole_word": f"SELECT id, {_WHOLE_WORD} AS asks_to_change FROM m_messages",
    "keyword_guards": f"""
        SELECT id, {_any('low', v.CHARGE_PHRASES)} AS charge,
               {_any('low', v.IDENTITY_PHRASES)} AS identity,
               {_any('low', v.CERTIFICATE_PHRASES)} AS certificate,
               {_any('low', v.TRANSFER_PHRASES)} AS transfer,
               {_any('low', v.ACCESS_PHRASES)} AS access,
               {_any('low', v.PREPAYMENT_PHRASES)} AS prepayment,
               {_any('low', v.RECEIPT_WORDS)} AS receipt FROM m_messages""",
    "discard_rule": "SELECT id, only_noise FROM m_noise",
    "prepayment_guard": f"""
        SELECT m.id, array_to_string(m.refs, '|') AS policy_refs,
               {_JOINED.format('r.ref', 'r.pos')} AS usable_refs
        FROM m_valid m LEFT JOIN m_refs r USING (id) GROUP BY m.id, m.refs""",
    "policy_grounding": "SELECT id, grounded FROM m_grounded",
    "render_reply": "SELECT id, answering_refs, reply FROM m_replies",
    "triage_results": "SELECT * FROM m_results",
    "triage_error_rows": "SELECT * FROM m_results WHERE technical_status = 'error'",
    "triage_counts": "SELECT * FROM m_counts",
    "triage_summary": f"""
        SELECT count(*) AS total_messages,
               count(*) FILTER (technical_status = 'ok') AS business_results,
               count(*) FILTER (technical_status = 'error') AS technical_errors,
               {_map('main_reason')} AS by_main_reason, {_map('priority')} AS by_priority,
               {_map('action')} AS by_action, {_map('queue')} AS by_queue,
               count(*) FILTER (action = '{v.ANSWER}') AS auto_answerable,
               count(*) FILTER (action = '{v.ANSWER}')
                   / nullif(count(*) FILTER (technical_status = 'ok'), 0) AS auto_answerable_ratio
        FROM m_results""",
    "dq_policy_refs": f"""
        SELECT id, '{UNKNOWN_REF}' AS policy_ref FROM m_messages WHERE c % 30 = 3""",
    "dq_triage_invariants": f"""
        SELECT id, 'queue_without_escalation' AS rule FROM m_results
        WHERE id LIKE '%-2' AND action IS DISTINCT FROM '{v.ESCALATE}'""",
}
