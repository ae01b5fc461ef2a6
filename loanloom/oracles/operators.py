"""Expected results of single operators in SQL."""

from __future__ import annotations

from loanloom.oracles.lending import CUT, day_text, dbl, local_day, ts_text, usd

EXTRACTS = {
    "raw_applications_cdc": "x_applications",
    "raw_customers": "x_customers",
    "raw_fx_rates": "x_fx",
    "raw_installments": "x_installments",
    "raw_loans": "x_loans",
    "raw_merchants_history": "x_merchants",
    "raw_payments": "x_payments",
}

# Payments that count at the cutoff, with their running total per loan.
PAID_AT_CUT = f"""
    SELECT *, sum(amount) OVER (PARTITION BY loan_id
              ORDER BY paid_at_utc, source_system, payment_id) AS paid_after
    FROM t_history
    WHERE {local_day('paid_at_utc')} <= {CUT}
      AND (reversed_at_utc IS NULL OR {local_day('reversed_at_utc')} > {CUT})"""

MOMENT = "(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)))"

OPERATOR_SQL: dict[str, str] = {
    "bronze_csv_roundtrip": "SELECT * FROM x_payments",
    "bronze_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS source, count(*) AS n_rows FROM {cte}"
        for name, cte in EXTRACTS.items()
    ),
    "layer_write_roundtrip": f"""
        SELECT loan_id, installment_number, {day_text('due_date')} AS due_date,
               {dbl('amount_due')} AS amount_due, {dbl('paid_amount')} AS paid_amount,
               {dbl('remaining_amount')} AS remaining_amount,
               {ts_text('settlement_at_utc')} AS settlement_at_utc,
               {day_text('settlement_date')} AS settlement_date,
               CAST(days_past_due AS INTEGER) AS days_past_due FROM t_final""",
    "export_csv_roundtrip": f"""
        SELECT CAST(loan_id AS VARCHAR) AS loan_id, CAST(customer_id AS VARCHAR) AS customer_id,
               CAST(merchant_id AS VARCHAR) AS merchant_id, currency,
               {day_text('disbursement_date')} AS disbursement_date,
               CAST(CAST(balance_local AS DECIMAL(18, 2)) AS VARCHAR) AS balance_local,
               CAST(balance_usd AS VARCHAR) AS balance_usd, CAST(dpd AS VARCHAR) AS dpd, dpd_bucket
        FROM t_snapshot""",
    "cast_tolerant": f"""
        SELECT customer_id, TRY_CAST(birth_year AS INTEGER) AS birth_year,
               {dbl('TRY_CAST(trim(monthly_income) AS DECIMAL(18, 2))')} AS plain_income,
               TRY_CAST(document_number AS BIGINT) AS numeric_document FROM x_customers""",
    "text_cleanup": """
        SELECT customer_id, trim(country) AS country,
               CASE WHEN trim(city) <> '' THEN trim(city) END AS city,
               CASE WHEN trim(city) <> '' THEN trim(city) ELSE 'UNKNOWN' END AS city_or_default,
               CASE WHEN trim(email) <> '' THEN lower(trim(email)) END AS email FROM x_customers""",
    "income_parse": f"""
        SELECT customer_id, monthly_income,
               {dbl("TRY_CAST(string_agg(part, '' ORDER BY i) AS DECIMAL(18, 2))")} AS income
        FROM (SELECT customer_id, monthly_income,
                     unnest(string_split(trim(monthly_income), ',')) AS part,
                     generate_subscripts(string_split(trim(monthly_income), ','), 1) AS i
              FROM x_customers) GROUP BY customer_id, monthly_income""",
    "payment_normalize": f"""
        SELECT CAST(payment_id AS BIGINT) AS payment_id, source_system,
               CAST(regexp_extract(loan_ref, '[0-9]+') AS BIGINT) AS loan_id,
               {ts_text('moment')} AS paid_at_utc,
               CASE WHEN source_system = 'legacy_v1' THEN CAST(amount_raw AS BIGINT) / 100
                    ELSE CAST(amount_raw AS DOUBLE) END AS amount,
               payment_method, status, CAST(reversed_payment_id AS BIGINT) AS reversed_payment_id
        FROM (SELECT *, CASE WHEN contains(paid_at_utc, '-')
                             THEN CAST(replace(replace(paid_at_utc, 'T', ' '), 'Z', '') AS TIMESTAMP)
                             ELSE epoch_ms(CAST(paid_at_utc AS BIGINT)) END AS moment
              FROM x_payments)""",
    "dedup_after_parse": f"""
        SELECT loan_id, application_id, merchant_id, {dbl('principal')} AS principal, currency,
               term_months, {dbl('apr')} AS apr, {ts_text('disbursed_at_utc')} AS disbursed_at_utc,
               status FROM t_loan_rows""",
    "dpd_bucket": f"""
        SELECT o_orderkey, CAST(dpd AS INTEGER) AS dpd,
               CASE WHEN dpd = 0 THEN '0' WHEN dpd BETWEEN 1 AND 30 THEN '1-30'
                    WHEN dpd BETWEEN 31 AND 60 THEN '31-60' WHEN dpd BETWEEN 61 AND 90 THEN '61-90'
                    ELSE '90+' END AS dpd_bucket
        FROM (SELECT o_orderkey,
                     greatest(date_diff('day', CAST(o_orderdate AS DATE), {CUT}), 0) % 120 AS dpd
              FROM orders)""",
    "sentinel_resolution": """
        SELECT application_id, last.customer_id AS reported_customer_id,
               CASE WHEN last.customer_id = 999999999 THEN known_id ELSE last.customer_id END
                   AS customer_id
        FROM (SELECT application_id, arg_max(e, (event_at, ingested_at,
                         CASE op WHEN 'D' THEN 2 WHEN 'U' THEN 1 ELSE 0 END)) AS last
              FROM t_events e GROUP BY application_id)
        LEFT JOIN t_known USING (application_id)""",
    "money_convert": f"""
        SELECT source_system, payment_id, {dbl('amount')} AS amount,
               {dbl(usd('amount', 'f.units'))} AS amount_usd
        FROM t_payment p ASOF LEFT JOIN t_fx f
          ON p.currency = f.currency AND p.paid_date >= f.rate_date""",
    "parse_mixed_timestamps": f"""
        SELECT o_orderkey, form, written, {ts_text('moment')} AS instant
        FROM (SELECT o_orderkey, CAST(o_orderkey % 12 AS INTEGER) AS form,
                CASE o_orderkey % 12
                    WHEN 0 THEN strftime({MOMENT}, '%Y-%m-%d %H:%M:%S')
                    WHEN 1 THEN strftime({MOMENT}, '%Y-%m-%dT%H:%M:%SZ')
                    WHEN 2 THEN CAST(epoch_ms({MOMENT}) AS VARCHAR)
                    WHEN 3 THEN strftime({MOMENT}, '%Y-%m-%dT%H:%M:%S-05:00')
                    WHEN 4 THEN strftime({MOMENT}, '%Y-%m-%dT%H:%M:%S')
                    WHEN 5 THEN '' WHEN 6 THEN '  '
                    WHEN 7 THEN 'junk' || o_orderkey
                    WHEN 8 THEN strftime(o_orderdate, '%Y-%m')
                    WHEN 9 THEN 'T05:00'
                    WHEN 10 THEN '-' || (o_orderkey * 1000 + 1)
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS written,
                CASE WHEN o_orderkey % 12 IN (0, 1, 2, 4) THEN {MOMENT}
                     WHEN o_orderkey % 12 = 3 THEN {MOMENT} + INTERVAL 5 HOUR
                     WHEN o_orderkey % 12 = 10 THEN epoch_ms(-(o_orderkey * 1000 + 1))
                     WHEN o_orderkey % 12 = 11 THEN o_orderdate END AS moment
              FROM orders)""",
    "local_business_date": f"""
        SELECT o_orderkey, {day_text(local_day(MOMENT))} AS local_day,
               strftime({local_day(MOMENT)}, '%Y-%m-01') AS local_month FROM orders""",
    "join_valid_loans": f"""
        SELECT loan_id, application_id, customer_id, merchant_id, {dbl('principal')} AS principal
        FROM t_loan""",
    "scd2_join": f"""
        SELECT application_id, a.merchant_id, {day_text('created_on')} AS created_on, m.category,
               {day_text('m.valid_from')} AS valid_from
        FROM (SELECT *, {local_day('created_at_utc')} AS created_on FROM t_application) a
        ASOF JOIN t_merchant m ON a.merchant_id = m.merchant_id AND a.created_on >= m.valid_from""",
    "asof_fx": f"""
        SELECT o_orderkey, o.currency, {day_text('day')} AS day, {dbl('f.units')} AS fx_units_per_usd
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CASE o_orderkey % 10
                         WHEN 0 THEN -3000 WHEN 1 THEN 3000 ELSE 0 END AS day,
                     CASE WHEN o_orderkey % 97 = 0 THEN 'USD' WHEN o_orderkey % 2 = 0 THEN 'COP'
                          ELSE 'BRL' END AS currency FROM orders) o
        ASOF LEFT JOIN t_fx f
          ON o.currency = f.currency AND o.day >= f.rate_date""",
    "effective_at_cutoff": f"""
        SELECT {day_text('c.cutoff_date')} AS cutoff_date, loan_id, {dbl('sum(amount)')} AS amount
        FROM t_history h JOIN (
            SELECT DISTINCT CAST(last_day(m) AS DATE) AS cutoff_date FROM (
                SELECT unnest(generate_series((SELECT min(paid_at_utc) FROM t_history)
                              - INTERVAL 1 MONTH, {CUT}, INTERVAL 5 DAY)) AS m)
            WHERE last_day(m) <= {CUT}) c
          ON {local_day('paid_at_utc')} <= c.cutoff_date
         AND (reversed_at_utc IS NULL OR {local_day('reversed_at_utc')} > c.cutoff_date)
        GROUP BY ALL""",
    "effective_spans": f"""
        SELECT source_system, payment_id, loan_id, {dbl('amount')} AS amount,
               {day_text('since')} AS counts_from,
               {day_text(f'CASE WHEN until <= {CUT} THEN until END')} AS counts_until
        FROM (SELECT *, last_day({local_day('paid_at_utc')}) AS since,
                     last_day({local_day('reversed_at_utc')}) AS until FROM t_history)
        WHERE since <= {CUT} AND (until IS NULL OR until > since)""",
    "fifo_settlement": f"""
        SELECT i.loan_id, i.installment_number, {ts_text('min(p.paid_at_utc)')} AS settlement_at_utc
        FROM t_plan i JOIN ({PAID_AT_CUT}) p
          ON p.loan_id = i.loan_id AND p.paid_after >= i.due_end GROUP BY ALL""",
    "fifo_allocation": f"""
        SELECT loan_id, installment_number, {dbl('amount_due')} AS amount_due,
               {dbl('paid_amount')} AS paid_amount FROM t_final""",
    "running_due_ranges": f"""
        SELECT loan_id, installment_number, {dbl('due_end - amount_due')} AS due_before,
               {dbl('due_end')} AS due_end
        FROM (SELECT DISTINCT CAST(loan_id AS BIGINT) AS loan_id,
                     CAST(installment_number AS INTEGER) AS installment_number,
                     CAST(amount_due AS DECIMAL(18, 2)) AS amount_due FROM x_installments) a
        JOIN (SELECT a.loan_id, a.installment_number, sum(b.amount_due) AS due_end
              FROM (SELECT DISTINCT CAST(loan_id AS BIGINT) AS loan_id,
                           CAST(installment_number AS INTEGER) AS installment_number
                    FROM x_installments) a
              JOIN (SELECT DISTINCT CAST(loan_id AS BIGINT) AS loan_id,
                           CAST(installment_number AS INTEGER) AS n,
                           CAST(amount_due AS DECIMAL(18, 2)) AS amount_due FROM x_installments) b
                ON a.loan_id = b.loan_id AND b.n <= a.installment_number GROUP BY ALL) s
          USING (loan_id, installment_number)""",
    "running_paid_ranges": f"""
        SELECT loan_id, source_system, payment_id, {dbl('paid_after - amount')} AS paid_before,
               {dbl('paid_after')} AS paid_after FROM ({PAID_AT_CUT})""",
    "month_end_calendar": f"SELECT {day_text('cutoff_date')} AS cutoff_date FROM t_calendar",
    "conditional_aggregates": f"""
        SELECT merchant_id, count(*) AS n_applications,
               count(*) FILTER (status = 'APPROVED') AS n_approved,
               {dbl("sum(approved_amount) FILTER (status = 'APPROVED')")} AS approved_total,
               {dbl("max(approved_amount) FILTER (currency = 'COP')")} AS largest_cop,
               {dbl('coalesce(sum(approved_amount) FILTER (approved_amount > 490000), 0)')}
                   AS large_total
        FROM t_application GROUP BY merchant_id""",
    "ids_per_person": """
        SELECT document_number, count(*) AS customer_id_count
        FROM (SELECT DISTINCT document_number, customer_id FROM t_customer_rows)
        GROUP BY document_number""",
    "safe_ratio": """
        SELECT *, CASE WHEN n_large > 0 THEN n_large_approved / n_large END AS large_rate
        FROM (SELECT merchant_id,
                     count(*) FILTER (requested_amount > 495000 AND status = 'APPROVED')
                         AS n_large_approved,
                     count(*) FILTER (requested_amount > 495000) AS n_large
              FROM t_application GROUP BY merchant_id)""",
    "cast_strict": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 8 IN (1, 2, 3, 6) THEN NULL
                    WHEN o_orderkey % 8 = 5 THEN -o_orderkey ELSE o_orderkey END AS number,
               CASE WHEN o_orderkey % 4 IN (0, 3) THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
        FROM orders""",
    "cdc_latest_state": f"""
        SELECT application_id, op, status, {ts_text('event_at')} AS event_at_utc,
               {ts_text('first_at')} AS created_at_utc
        FROM (SELECT *, min(event_at) OVER (PARTITION BY application_id) AS first_at FROM t_events)
        QUALIFY row_number() OVER (PARTITION BY application_id
                ORDER BY event_at DESC NULLS LAST, ingested_at DESC NULLS LAST,
                         CASE op WHEN 'D' THEN 2 WHEN 'U' THEN 1 ELSE 0 END DESC) = 1""",
    "person_survivorship": f"""
        SELECT document_number, last.customer_id AS customer_id,
               {ts_text('last.created_at_utc')} AS created_at_utc, customer_id_count
        FROM (SELECT document_number, arg_max(r, (created_at_utc, customer_id)) AS last,
                     count(DISTINCT customer_id) AS customer_id_count
              FROM t_customer_rows r GROUP BY document_number)""",
    "scd2_intervals": f"""
        SELECT merchant_id, {day_text('valid_from')} AS valid_from,
               {day_text('valid_to')} AS valid_to, is_current FROM t_merchant""",
    "merchant_month_spine": f"""
        SELECT merchant_id, strftime({local_day('created_at_utc')}, '%Y-%m-01') AS month
        FROM t_application UNION
        SELECT merchant_id, strftime(disbursement_date, '%Y-%m-01') FROM t_loan UNION
        SELECT merchant_id, strftime(paid_date, '%Y-%m-01') FROM t_payment""",
    "table_diff": f"""
        WITH l AS (SELECT CAST(loan_id AS BIGINT) AS loan_id,
                          CAST(application_id AS BIGINT) AS application_id,
                          CAST(merchant_id AS BIGINT) AS merchant_id,
                          CAST(principal AS DECIMAL(18, 2)) AS principal FROM x_loans),
             r AS (SELECT loan_id, application_id, merchant_id,
                          CAST(principal + CASE WHEN loan_id % 50 = 0 THEN 1 ELSE 0 END
                               AS DECIMAL(18, 2)) AS principal FROM t_loan)
        SELECT loan_id, application_id, merchant_id, {dbl('principal')} AS principal, only_in,
               count(*) AS n_rows
        FROM (SELECT *, 'left' AS only_in FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
              UNION ALL
              SELECT *, 'right' FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l))
        GROUP BY ALL""",
    "dq_unique_combination": """
        SELECT source_system, CAST(payment_id AS BIGINT) AS payment_id, count(*) AS n_rows
        FROM x_payments GROUP BY ALL HAVING count(*) > 1""",
    "dq_unique": """
        SELECT document_number, count(*) AS n_rows FROM x_customers
        GROUP BY document_number HAVING count(*) > 1""",
    "dq_not_null": "SELECT application_id, status FROM t_application WHERE customer_id IS NULL",
    "dq_not_negative": f"""
        SELECT customer_id, {dbl('monthly_income')} AS monthly_income
        FROM t_customer_rows WHERE monthly_income < 0""",
    "dq_between_0_and_1": f"""
        SELECT loan_id, paid_share FROM (
            SELECT l.loan_id, {dbl('sum(p.amount)')} / {dbl('l.principal')} AS paid_share
            FROM t_loan l JOIN ({PAID_AT_CUT}) p USING (loan_id) GROUP BY l.loan_id, l.principal)
        WHERE NOT paid_share BETWEEN 0 AND 1""",
    "dq_accepted_values": """
        SELECT category, count(*) AS n_rows FROM t_merchant
        WHERE category NOT IN ('EDUCATION', 'ELECTRONICS', 'FASHION', 'HEALTH', 'HOME',
                               'MOTORCYCLES', 'TRAVEL') GROUP BY category""",
    "dq_relationships": """
        SELECT loan_id, application_id FROM t_loan_rows
        WHERE application_id NOT IN (SELECT application_id FROM t_application)""",
    "dq_reversals_resolve": """
        SELECT r.source_system, r.reversed_payment_id AS payment_id,
               count(DISTINCT r.payment_id) AS n_reversals,
               count(DISTINCT s.payment_id) AS n_settled
        FROM t_payment_rows r LEFT JOIN t_payment_rows s
          ON s.status = 'SETTLED' AND s.source_system = r.source_system
         AND s.payment_id = r.reversed_payment_id
        WHERE r.status = 'REVERSED' GROUP BY ALL
        HAVING count(DISTINCT r.payment_id) > 1 OR count(DISTINCT s.payment_id) <> 1""",
    "dq_fifo_conservation": f"""
        WITH damaged AS (
            SELECT cutoff_date, loan_id, installment_number AS n, amount_due AS due,
                   CASE WHEN loan_id % 97 = 0 AND n = 1 THEN paid_amount + 1
                        WHEN loan_id % 89 = 0 AND n = 1 THEN 0
                        WHEN loan_id % 83 = 0 AND n = 2 THEN -1 ELSE paid_amount END AS paid,
                   CASE WHEN loan_id % 97 = 0 AND n = 1 THEN remaining_amount
                        WHEN loan_id % 89 = 0 AND n = 1 THEN due
                        WHEN loan_id % 83 = 0 AND n = 2 THEN due + 1
                        ELSE remaining_amount END AS remaining FROM t_status),
        received AS (SELECT cutoff_date, loan_id, sum(amount) AS got FROM t_received GROUP BY ALL),
        broken AS (
            SELECT cutoff_date, loan_id, 'row' AS rule FROM damaged
            WHERE least(paid, remaining) < 0 OR abs(paid + remaining - due) > 0.005
            UNION
            SELECT a.cutoff_date, a.loan_id, 'row' FROM damaged a JOIN damaged b
              ON a.cutoff_date = b.cutoff_date AND a.loan_id = b.loan_id AND b.n < a.n
            WHERE a.paid > 0 AND b.remaining > 0.005
            UNION
            SELECT cutoff_date, loan_id, 'total'
            FROM (SELECT cutoff_date, loan_id, sum(paid) AS spent, sum(due) AS owed
                  FROM damaged GROUP BY ALL) LEFT JOIN received USING (cutoff_date, loan_id)
            WHERE abs(spent - least(owed, coalesce(got, 0))) > 0.005)
        SELECT {day_text('cutoff_date')} AS cutoff_date, loan_id, rule FROM broken""",
    "dq_reconciliation": f"""
        SELECT rule, {dbl('expected')} AS expected, {dbl('actual')} AS actual,
               expected = actual AS agrees
        FROM (SELECT 'loans_less_orphans' AS rule, count(*) FILTER (application_id IN (
                         SELECT application_id FROM t_application WHERE status = 'APPROVED'))
                         AS expected,
                     (SELECT count(*) FROM t_loan) AS actual FROM t_loan_rows
              UNION ALL
              SELECT 'ids_of_people', count(DISTINCT customer_id),
                     (SELECT sum(customer_id_count) FROM t_customer) FROM x_customers
              UNION ALL
              SELECT 'late_plus_current',
                     sum(balance_usd) FILTER (dpd > 30) + sum(balance_usd) FILTER (dpd <= 30),
                     sum(balance_usd) FROM t_snapshot
              UNION ALL
              SELECT 'extract_rows', count(*), (SELECT count(*) FROM x_loans) FROM t_loan_rows)""",
    "dq_source_profile": """
        WITH incomes AS (
            SELECT trim(monthly_income) AS raw_text,
                   TRY_CAST(replace(trim(monthly_income), ',', '') AS DECIMAL(18, 2)) AS income
            FROM x_customers),
        styles AS (
            SELECT source_system, payment_id FROM x_payments GROUP BY ALL
            HAVING count(DISTINCT CASE WHEN contains(paid_at_utc, 'T') THEN 1
                                       WHEN contains(paid_at_utc, ' ') THEN 2 ELSE 3 END) > 1)
        SELECT 'raw_customers' AS source, 'n_rows' AS measure, count(*) AS n FROM x_customers
        UNION ALL SELECT 'raw_customers', 'n_duplicates', count(*) - (
            SELECT count(*) FROM (SELECT DISTINCT * FROM x_customers)) FROM x_customers
        UNION ALL SELECT 'raw_customers', 'unreadable_income',
            count(*) FILTER (raw_text <> '' AND income IS NULL) FROM incomes
        UNION ALL SELECT 'raw_customers', 'negative_income', count(*) FILTER (income < 0) FROM incomes
        UNION ALL SELECT 'raw_merchants_history', 'n_rows', count(*) FROM x_merchants
        UNION ALL SELECT 'raw_merchants_history', 'n_duplicates', count(*) - (
            SELECT count(*) FROM (SELECT DISTINCT * FROM x_merchants)) FROM x_merchants
        UNION ALL SELECT 'raw_merchants_history', 'missing_category', count(*) FROM x_merchants
            WHERE trim(category) = ''
        UNION ALL SELECT 'typed_payments', 'n_rows', count(*) FROM x_payments
        UNION ALL SELECT 'typed_payments', 'n_duplicates', (SELECT count(*) FROM x_payments)
            - count(*) FROM t_payment_rows
        UNION ALL SELECT 'raw_payments', 'keys_with_mixed_encodings', count(*) FROM styles""",
    "dq_scd2_partition": f"""
        WITH kept AS (
            SELECT * FROM (SELECT *, min(valid_from) OVER (PARTITION BY merchant_id) AS first_from
                           FROM t_merchant)
            WHERE merchant_id % 4 <> 2 OR valid_from = first_from OR is_current)
        SELECT merchant_id, {day_text('valid_from')} AS edge, CAST(1 AS BIGINT) AS balance FROM kept k
        WHERE valid_from <> first_from AND NOT EXISTS (
            SELECT 1 FROM kept o WHERE o.merchant_id = k.merchant_id AND o.valid_to = k.valid_from)
        UNION ALL
        SELECT merchant_id, {day_text('valid_to')}, CAST(-1 AS BIGINT) FROM kept k
        WHERE valid_to IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM kept o WHERE o.merchant_id = k.merchant_id AND o.valid_from = k.valid_to)""",
}
