"""Registered queries: single operators over the derived extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.catalog.lending import Query, lending
from loanloom.functions.instants import local_date, month_start, parse_utc
from loanloom.functions.money import (
    bucket,
    parse_grouped_money,
    parse_money,
    ratio,
    readable,
    strict,
    to_usd,
)
from loanloom.functions.text import blank_to_null
from loanloom.operators import quality
from loanloom.operators.allocation import (
    allocation_of,
    amounts_by_step,
    completed_at,
    due_ranges,
    effective_at,
    effective_span,
    month_ends_of_step,
    received_by_month_end,
    received_steps_of,
)
from loanloom.operators.allocation import month_end_calendar as calendar_of
from loanloom.operators.change_log import (
    known_id_per_key,
    latest_state,
    repair_sentinel,
    survivor,
)
from loanloom.operators.running import running_total
from loanloom.operators.temporal import (
    asof_join,
    interval_join,
    key_spine,
    look_up,
    version_intervals,
)
from loanloom.plans import lending as plans
from loanloom.samples.lending import CATEGORIES, CUTOFF, hours
from loanloom.sources import bronze
from loanloom.sources.export import export_table

OPERATORS: dict[str, Query] = {}


def query(function: Query) -> Query:
    OPERATORS[function.__name__] = function
    return function


# Sources and sinks


@query
def bronze_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """All seven extracts written as CSV and read back; the payments are shown."""
    tables = lending(spark, folder)
    root = tables.layers.path("bronze", "csv")
    for name, df in tables.raw.items():
        bronze.write_csv(df, f"{root}/{name}.csv")
    return bronze.read_extracts(spark, root)["raw_payments"]


@query
def bronze_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.row_counts(lending(spark, folder).raw)


@query
def layer_write_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The month-end table stored by cutoff, replaced, and one month read back."""
    tables = lending(spark, folder)
    first = plans.int_installment_status(tables.ledger_at(date(1998, 12, 31)))
    tables.layers.write(first, "silver", "int_installment_status", ["cutoff_date"])
    full = plans.int_installment_status(tables.ledger)
    stored = tables.layers.write(
        full, "silver", "int_installment_status", ["cutoff_date"]
    )
    return plans.final_status(stored, CUTOFF)


@query
def export_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The loan snapshot exported in order of its grain and read back as text."""
    tables = lending(spark, folder)
    path = tables.layers.path("exports", "dm_loan_delinquency_snapshot")
    snapshot = tables.dm_loan_delinquency_snapshot
    export_table(snapshot, path, ["loan_id"])
    return bronze.read_extract(spark, path, snapshot.columns)


# Projections, casts and scalar functions


@query
def cast_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    raw = lending(spark, folder).raw["raw_customers"]
    return raw.select(
        "customer_id",
        F.col("birth_year").try_cast("int").alias("birth_year"),
        parse_money(F.col("monthly_income")).alias("plain_income"),
        F.col("document_number").try_cast("bigint").alias("numeric_document"),
    )


@query
def text_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    raw = lending(spark, folder).raw["raw_customers"]
    return raw.select(
        "customer_id",
        F.trim("country").alias("country"),
        blank_to_null(F.col("city")).alias("city"),
        F.coalesce(blank_to_null(F.col("city")), F.lit("UNKNOWN")).alias("city_or_default"),
        blank_to_null(F.lower("email")).alias("email"),
    )


@query
def income_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw = lending(spark, folder).raw["raw_customers"]
    return raw.select(
        "customer_id",
        "monthly_income",
        parse_grouped_money(F.col("monthly_income")).alias("income"),
    )


@query
def payment_normalize(spark: SparkSession, folder: str) -> DataFrame:
    raw = lending(spark, folder).raw["raw_payments"]
    return plans.typed_payment_events(raw)


@query
def dedup_after_parse(spark: SparkSession, folder: str) -> DataFrame:
    return plans.typed_loans(lending(spark, folder).raw["raw_loans"])


@query
def dpd_bucket(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    late = F.greatest(F.datediff(F.lit(CUTOFF), F.to_date("o_orderdate")), F.lit(0)) % 120
    return orders.select("o_orderkey", late.alias("dpd")).withColumn(
        "dpd_bucket", bucket(F.col("dpd"), plans.DPD_EDGES)
    )


@query
def sentinel_resolution(spark: SparkSession, folder: str) -> DataFrame:
    raw = lending(spark, folder).raw
    events = plans.typed_application_events(raw["raw_applications_cdc"])
    last = latest_state(events, ["application_id"], plans.EVENT_ORDER).select(
        "application_id", "customer_id"
    )
    master = raw["raw_customers"].select(
        strict(F.col("customer_id"), "bigint").alias("customer_id")
    )
    known = known_id_per_key(
        events, "application_id", "customer_id", plans.UNKNOWN_CUSTOMER, master
    )
    reported = last.withColumn("reported_customer_id", F.col("customer_id"))
    return repair_sentinel(
        reported, known, "application_id", "customer_id", plans.UNKNOWN_CUSTOMER
    )


@query
def money_convert(spark: SparkSession, folder: str) -> DataFrame:
    """Valid payments in USD at the payment date's rate."""
    tables = lending(spark, folder)
    rated = look_up(tables.fct_payment, tables.rates, ["currency"], "paid_date")
    return rated.select(
        "source_system",
        "payment_id",
        "amount",
        to_usd(F.col("amount"), F.col("fx_units_per_usd")).alias("amount_usd"),
    )


@query
def parse_mixed_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Every order date written in one of twelve forms and parsed back."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    k = F.col("o_orderkey")
    moment = F.col("o_orderdate") + hours(k % 24)
    plain = moment.cast("string")
    iso = F.replace(plain, F.lit(" "), F.lit("T"))
    utc = F.concat(iso, F.lit("Z"))
    forms = [
        plain,
        utc,
        F.unix_millis(utc.cast("timestamp")).cast("string"),
        F.concat(iso, F.lit("-05:00")),
        iso,
        F.lit(""),
        F.lit("  "),
        F.concat(F.lit("junk"), k.cast("string")),
        F.date_format("o_orderdate", "yyyy-MM"),
        F.lit("T05:00"),
        F.concat(F.lit("-"), (k * 1000 + 1).cast("string")),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    ]
    form = (k % len(forms)).cast("int")
    text = F.element_at(F.array(*forms), form + 1)
    return orders.select(
        "o_orderkey", form.alias("form"), text.alias("written")
    ).withColumn("instant", parse_utc(F.col("written")))


@query
def local_business_date(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    moment = F.col("o_orderdate") + hours(F.col("o_orderkey") % 24)
    day = local_date(moment)
    return orders.select(
        "o_orderkey", day.alias("local_day"), month_start(day).alias("local_month")
    )


# Joins


@query
def join_valid_loans(spark: SparkSession, folder: str) -> DataFrame:
    tables = lending(spark, folder)
    return plans.valid_loans(tables.raw["raw_loans"], tables.fct_application).select(
        "loan_id", "application_id", "customer_id", "merchant_id", "principal"
    )


@query
def scd2_join(spark: SparkSession, folder: str) -> DataFrame:
    tables = lending(spark, folder)
    created = tables.fct_application.select(
        "application_id",
        "merchant_id",
        local_date(F.col("created_at_utc")).alias("created_on"),
    )
    return interval_join(
        created, tables.dim_merchant, "merchant_id", "created_on"
    ).select("application_id", "merchant_id", "created_on", "category", "valid_from")


@query
def asof_fx(spark: SparkSession, folder: str) -> DataFrame:
    """Rates looked up for order days, some moved before the first or past the last."""
    tables = lending(spark, folder)
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    k = F.col("o_orderkey")
    currency = F.when(k % 97 == 0, "USD").when(k % 2 == 0, "COP").otherwise("BRL")
    moved = F.when(k % 10 == 0, -3000).when(k % 10 == 1, 3000).otherwise(0)
    rows = orders.select(
        k, currency.alias("currency"), F.date_add(F.to_date("o_orderdate"), moved).alias("day")
    )
    return asof_join(
        rows, tables.fx, {"currency": "currency"}, "day", "rate_date", "fx_units_per_usd"
    )


@query
def effective_at_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    """What counts at each month-end, summed per loan before months are spread."""
    history = lending(spark, folder).stored_payment_history
    return received_by_month_end(history, CUTOFF)


@query
def effective_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Per payment the first month-end at which it counts and the one at which it stops."""
    spans = effective_span(lending(spark, folder).stored_payment_history, CUTOFF)
    return spans.select(
        "source_system", "payment_id", "loan_id", "amount", "counts_from", "counts_until"
    )


@query
def fifo_settlement(spark: SparkSession, folder: str) -> DataFrame:
    """Instant at which each installment was completed, as of the cutoff."""
    book = lending(spark, folder).ledger
    return completed_at(book.plan, book, one_epoch=True).select(
        "loan_id", "installment_number", "settlement_at_utc"
    )


@query
def fifo_allocation(spark: SparkSession, folder: str) -> DataFrame:
    status = allocation_of(
        lending(spark, folder).ledger, final_only=True, with_settlement=False
    )
    return status.select("loan_id", "installment_number", "amount_due", "paid_amount")


@query
def running_due_ranges(spark: SparkSession, folder: str) -> DataFrame:
    raw = lending(spark, folder).raw["raw_installments"]
    return due_ranges(plans.typed_installments(raw).distinct()).select(
        "loan_id", "installment_number", "due_before", "due_end"
    )


@query
def running_paid_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Running totals of the payments that count at the cutoff."""
    tables = lending(spark, folder)
    counting = effective_at(tables.stored_payment_history, CUTOFF)
    return running_total(
        counting.select("loan_id", "source_system", "payment_id", "paid_at_utc", "amount"),
        ["loan_id"],
        ["paid_at_utc", "source_system", "payment_id"],
        "amount",
        lambda df: tables.layers.write(df, "silver", "paid_pieces"),
        "paid_before",
        "paid_after",
    ).select("loan_id", "source_system", "payment_id", "paid_before", "paid_after")


@query
def month_end_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return calendar_of(lending(spark, folder).fct_loan, CUTOFF)


# Aggregates, windows and sets


@query
def conditional_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    approved = F.col("status") == "APPROVED"
    amount = F.col("approved_amount")
    return (
        lending(spark, folder)
        .fct_application.groupBy("merchant_id")
        .agg(
            F.count("*").alias("n_applications"),
            F.count_if(approved).alias("n_approved"),
            F.sum(F.when(approved, amount)).alias("approved_total"),
            F.max(F.when(F.col("currency") == "COP", amount)).alias("largest_cop"),
            F.coalesce(
                F.sum(F.when(amount > 490000, amount)), F.lit(0).cast("decimal(28,2)")
            ).alias("large_total"),
        )
    )


@query
def ids_per_person(spark: SparkSession, folder: str) -> DataFrame:
    typed = plans.typed_customers(lending(spark, folder).raw["raw_customers"])
    return typed.groupBy("document_number").agg(
        F.count_distinct("customer_id").alias("customer_id_count")
    )


@query
def safe_ratio(spark: SparkSession, folder: str) -> DataFrame:
    large = F.col("requested_amount") > 495000
    return (
        lending(spark, folder)
        .fct_application.groupBy("merchant_id")
        .agg(
            F.count_if(large & (F.col("status") == "APPROVED")).alias("n_large_approved"),
            F.count_if(large).alias("n_large"),
        )
        .withColumn("large_rate", ratio(F.col("n_large_approved"), F.col("n_large")))
    )


@query
def cast_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of whole numbers and days, some misshapen; what is refused is null."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    k = F.col("o_orderkey")
    key, day = k.cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd")
    number = (
        F.when(k % 8 == 1, F.concat(key, F.lit("x")))
        .when(k % 8 == 2, " ")
        .when(k % 8 == 3, F.concat(key, F.lit("e3")))
        .when(k % 8 == 4, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(k % 8 == 5, F.concat(F.lit("-"), key))
        .when(k % 8 == 6, F.concat(key, F.lit(".0")))
        .otherwise(key)
    )
    date_text = (
        F.when(k % 4 == 1, F.substring(day, 1, 7))
        .when(k % 4 == 2, F.concat(day, F.lit(" 00:00:00")))
        .when(k % 4 == 3, F.concat(day, F.lit(" ")))
        .otherwise(day)
    )
    return orders.select(
        "o_orderkey",
        readable(number, "bigint").alias("number"),
        readable(date_text, "date").alias("day"),
    )


@query
def cdc_latest_state(spark: SparkSession, folder: str) -> DataFrame:
    """Final state per application, deleted ones included."""
    raw = lending(spark, folder).raw["raw_applications_cdc"]
    return latest_state(
        plans.typed_application_events(raw),
        ["application_id"],
        plans.EVENT_ORDER,
        created_at_utc=F.min("event_at_utc"),
    ).select("application_id", "op", "status", "event_at_utc", "created_at_utc")


@query
def person_survivorship(spark: SparkSession, folder: str) -> DataFrame:
    typed = plans.typed_customers(lending(spark, folder).raw["raw_customers"])
    return survivor(
        typed, ["document_number"], ["created_at_utc", "customer_id"], "customer_id"
    ).select("document_number", "customer_id", "created_at_utc", "customer_id_count")


@query
def scd2_intervals(spark: SparkSession, folder: str) -> DataFrame:
    raw = lending(spark, folder).raw["raw_merchants_history"]
    return version_intervals(
        plans.typed_merchants(raw), "merchant_id", "valid_from"
    ).select("merchant_id", "valid_from", "valid_to", "is_current")


@query
def merchant_month_spine(spark: SparkSession, folder: str) -> DataFrame:
    """Merchant-months with an application, a disbursement or a payment."""
    tables = lending(spark, folder)
    loans = tables.stored_loan
    applied = tables.fct_application.select(
        "merchant_id",
        month_start(local_date(F.col("created_at_utc"))).alias("month"),
    )
    disbursed = loans.select(
        "merchant_id", month_start(F.col("disbursement_date")).alias("month")
    )
    paid = plans.fct_payment(tables.int_payment_history, loans).select(
        "merchant_id", month_start(F.col("paid_date")).alias("month")
    )
    return key_spine([applied, disbursed, paid], ["merchant_id", "month"])


@query
def table_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Loan rows as extracted against the valid loans, some principals changed."""
    tables = lending(spark, folder)
    columns = ["loan_id", "application_id", "merchant_id", "principal"]
    raw = tables.raw["raw_loans"]
    left = raw.select(
        F.col("loan_id").cast("bigint"),
        F.col("application_id").cast("bigint"),
        F.col("merchant_id").cast("bigint"),
        parse_money(F.col("principal")).alias("principal"),
    )
    changed = F.when(F.col("loan_id") % 50 == 0, F.col("principal") + 1).otherwise(
        F.col("principal")
    )
    right = tables.fct_loan.select(*columns).withColumn(
        "principal", changed.cast("decimal(18,2)")
    )
    return quality.table_diff(left, right)


# Data quality


@query
def dq_unique_combination(spark: SparkSession, folder: str) -> DataFrame:
    events = plans.typed_payment_events(lending(spark, folder).raw["raw_payments"])
    return quality.unique_combination(events, ["source_system", "payment_id"])


@query
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unique(
        lending(spark, folder).raw["raw_customers"], "document_number"
    )


@query
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_null(lending(spark, folder).fct_application, "customer_id").select(
        "application_id", "status"
    )


@query
def dq_not_negative(spark: SparkSession, folder: str) -> DataFrame:
    typed = plans.typed_customers(lending(spark, folder).raw["raw_customers"])
    return quality.not_negative(typed, "monthly_income").select(
        "customer_id", "monthly_income"
    )


@query
def dq_between_0_and_1(spark: SparkSession, folder: str) -> DataFrame:
    """Loans whose effective payments exceed the principal."""
    tables = lending(spark, folder)
    paid = (
        effective_at(tables.stored_payment_history, CUTOFF)
        .groupBy("loan_id")
        .agg(F.sum("amount").alias("paid"))
    )
    shares = tables.fct_loan.join(paid, "loan_id").select(
        "loan_id", ratio(F.col("paid"), F.col("principal")).alias("paid_share")
    )
    return quality.between_0_and_1(shares, "paid_share")


@query
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.accepted_values(
        lending(spark, folder).dim_merchant, "category", CATEGORIES
    )


@query
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    tables = lending(spark, folder)
    return quality.relationships(
        plans.typed_loans(tables.raw["raw_loans"]),
        "application_id",
        tables.fct_application,
        "application_id",
    ).select("loan_id", "application_id")


@query
def dq_reversals_resolve(spark: SparkSession, folder: str) -> DataFrame:
    events = plans.typed_payment_events(lending(spark, folder).raw["raw_payments"])
    return quality.reversal_violations(
        events.select(
            "source_system", "payment_id", "status", "reversed_payment_id"
        ).distinct()
    )


@query
def dq_fifo_conservation(spark: SparkSession, folder: str) -> DataFrame:
    """The allocation falsified: a unit too much, a first installment reopened, a
    negative payment.

    Amounts hold for a whole step, so they are checked per step; what is found is
    spread to its month-ends."""
    tables = lending(spark, folder)
    loan, number = F.col("loan_id"), F.col("installment_number")
    paid, left = F.col("paid_amount"), F.col("remaining_amount")
    surplus = (loan % 97 == 0) & (number == 1)
    reopened = (loan % 89 == 0) & (number == 1)
    negative = (loan % 83 == 0) & (number == 2)
    status = amounts_by_step(tables.ledger).withColumns(
        {
            "paid_amount": F.when(surplus, paid + 1)
            .when(reopened, 0)
            .when(negative, -1)
            .otherwise(paid),
            "remaining_amount": F.when(surplus, left)
            .when(reopened, F.col("amount_due"))
            .when(negative, F.col("amount_due") + 1)
            .otherwise(left),
        }
    )
    broken = quality.fifo_violations_by_step(status, received_steps_of(tables.ledger))
    return month_ends_of_step(broken).select("cutoff_date", "loan_id", "rule")


@query
def dq_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Totals that must agree, and one that does not: extract rows hold copies."""
    tables = lending(spark, folder)
    raw_loans = tables.raw["raw_loans"]
    typed = plans.typed_loans(raw_loans)
    approved = tables.fct_application.where("status = 'APPROVED'")
    orphans = quality.relationships(typed, "application_id", approved, "application_id")

    def rows_of(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n"))

    n_typed = rows_of(typed)
    ids = tables.raw["raw_customers"].agg(F.count_distinct("customer_id").alias("expected"))
    people = tables.dim_customer.agg(F.sum("customer_id_count").alias("n"))
    usd, late = F.col("balance_usd"), F.col("dpd") > 30
    parts = [F.coalesce(F.sum(F.when(kind, usd)), F.lit(0)) for kind in (late, ~late)]
    return quality.reconcile(
        loans_less_orphans=n_typed.select(
            (F.col("n") - rows_of(orphans).scalar()).alias("expected"),
            rows_of(tables.stored_loan).scalar().alias("actual"),
        ),
        ids_of_people=ids.select("expected", people.scalar().alias("actual")),
        late_plus_current=tables.dm_loan_delinquency_snapshot.agg(
            (parts[0] + parts[1]).alias("expected"), F.sum(usd).alias("actual")
        ),
        extract_rows=n_typed.select(
            F.col("n").alias("expected"), rows_of(raw_loans).scalar().alias("actual")
        ),
    )


@query
def dq_source_profile(spark: SparkSession, folder: str) -> DataFrame:
    tables = lending(spark, folder)
    customers = tables.raw["raw_customers"]
    income = F.trim("monthly_income")
    parsed = parse_grouped_money(F.col("monthly_income"))
    payments = tables.raw["raw_payments"]
    style = F.when(F.col("paid_at_utc").rlike("^-?[0-9]+$"), 2).otherwise(
        F.col("paid_at_utc").contains("T").cast("int")
    )
    mixed = quality.mixed_styles(payments, ["source_system", "payment_id"], style)
    return (
        quality.source_profile(
            customers,
            "raw_customers",
            unreadable_income=(income != "") & parsed.isNull(),
            negative_income=parsed < 0,
        )
        .unionByName(
            quality.source_profile(
                tables.raw["raw_merchants_history"],
                "raw_merchants_history",
                missing_category=blank_to_null(F.col("category")).isNull(),
            )
        )
        .unionByName(
            quality.source_profile(
                plans.typed_payment_events(payments), "typed_payments"
            )
        )
        .unionByName(
            mixed.agg(F.count("*").alias("n")).select(
                F.lit("raw_payments").alias("source"),
                F.lit("keys_with_mixed_encodings").alias("measure"),
                "n",
            )
        )
    )


@query
def dq_scd2_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Merchant versions with every middle version of some merchants removed."""
    versions = lending(spark, folder).dim_merchant
    first = versions.groupBy("merchant_id").agg(F.min("valid_from").alias("_first"))
    damaged = (
        versions.join(first, "merchant_id")
        .where(
            (F.col("merchant_id") % 4 != 2)
            | (F.col("valid_from") == F.col("_first"))
            | F.col("is_current")
        )
        .drop("_first")
    )
    return quality.overlapping_or_gapped(damaged, "merchant_id")
