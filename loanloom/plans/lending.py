"""The lending tables: typed entities, installment status and reporting grains.

Every function takes the frames it reads and returns a lazy frame. ``Lending``
wires them together over a set of text extracts and stores the tables that more
than one consumer reads.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.instants import (
    local_date,
    month_start,
    parse_utc,
    require_month_end,
)
from loanloom.functions.money import (
    MONEY,
    USD,
    bucket,
    from_minor_units,
    parse_grouped_money,
    parse_money,
    ratio,
    strict,
    to_usd,
)
from loanloom.functions.text import blank_to_null
from loanloom.operators.allocation import Ledger, Shown, allocation_of, balances_of, ledger
from loanloom.operators.change_log import (
    known_id_per_key,
    latest_state,
    repair_sentinel,
    survivor,
)
from loanloom.operators.temporal import (
    Curves,
    curves,
    interval_join,
    look_up,
    version_intervals,
)
from loanloom.sources.layers import Layers, pieces_for

# Fixed values of the source data.
UNKNOWN_CUSTOMER = 999999999
LEGACY_SYSTEM = "legacy_v1"
LEGACY_LOAN_PREFIX = "LN-"
DPD_EDGES = (30, 60, 90)
#: What makes a change the latest; at one moment a delete beats an update, that an insert.
EVENT_ORDER = ["event_at_utc", "ingested_at_utc", "op_rank"]


# Typed extracts


def typed_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("document_number").alias("document_number"),
        strict(F.col("customer_id"), "bigint").alias("customer_id"),
        F.trim("country").alias("country"),
        blank_to_null(F.col("city")).alias("city"),
        blank_to_null(F.lower("email")).alias("email"),
        F.col("birth_year").try_cast("int").alias("birth_year"),
        parse_grouped_money(F.col("monthly_income")).alias("monthly_income"),
        parse_utc(F.col("created_at")).alias("created_at_utc"),
    )


def typed_merchants(raw: DataFrame) -> DataFrame:
    return raw.select(
        strict(F.col("merchant_id"), "bigint").alias("merchant_id"),
        F.trim("merchant_name").alias("merchant_name"),
        F.coalesce(blank_to_null(F.col("category")), F.lit("UNKNOWN")).alias("category"),
        F.trim("country").alias("country"),
        strict(F.col("valid_from"), "date").alias("valid_from"),
    )


def typed_application_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        strict(F.col("application_id"), "bigint").alias("application_id"),
        strict(F.col("customer_id"), "bigint").alias("customer_id"),
        strict(F.col("merchant_id"), "bigint").alias("merchant_id"),
        F.trim("currency").alias("currency"),
        parse_money(F.col("requested_amount")).alias("requested_amount"),
        parse_money(F.col("approved_amount")).alias("approved_amount"),
        F.trim("status").alias("status"),
        parse_utc(F.col("event_at_utc")).alias("event_at_utc"),
        parse_utc(F.col("_ingested_at_utc")).alias("ingested_at_utc"),
        F.trim("_op").alias("op"),
    ).withColumn("op_rank", F.when(F.col("op") == "D", 2).when(F.col("op") == "U", 1).otherwise(0))


def typed_loans(raw: DataFrame) -> DataFrame:
    """Distinct after parsing, so two encodings of one instant collapse."""
    return raw.select(
        strict(F.col("loan_id"), "bigint").alias("loan_id"),
        strict(F.col("application_id"), "bigint").alias("application_id"),
        strict(F.col("merchant_id"), "bigint").alias("merchant_id"),
        parse_money(F.col("principal")).alias("principal"),
        F.trim("currency").alias("currency"),
        F.trim("term_months").try_cast("int").alias("term_months"),
        F.trim("apr").try_cast("decimal(12,6)").alias("apr"),
        parse_utc(F.col("disbursed_at_utc")).alias("disbursed_at_utc"),
        F.trim("status").alias("status"),
    ).distinct()


def typed_installments(raw: DataFrame) -> DataFrame:
    return raw.select(
        strict(F.col("loan_id"), "bigint").alias("loan_id"),
        strict(F.col("installment_number"), "int").alias("installment_number"),
        strict(F.col("due_date"), "date").alias("due_date"),
        strict(F.col("amount_due"), MONEY).alias("amount_due"),
    )


def typed_payment_events(raw: DataFrame) -> DataFrame:
    """Payment and reversal rows with one loan id form and major currency units."""
    system = F.trim("source_system")
    legacy = system == LEGACY_SYSTEM
    loan_ref = F.trim("loan_ref")
    bare_ref = F.when(
        legacy, F.replace(loan_ref, F.lit(LEGACY_LOAN_PREFIX), F.lit(""))
    ).otherwise(loan_ref)
    amount = F.col("amount_raw")
    return raw.select(
        strict(F.col("payment_id"), "bigint").alias("payment_id"),
        system.alias("source_system"),
        strict(bare_ref, "bigint").alias("loan_id"),
        parse_utc(F.col("paid_at_utc")).alias("paid_at_utc"),
        F.when(legacy, from_minor_units(amount))
        .otherwise(strict(amount, MONEY))
        .alias("amount"),
        F.trim("payment_method").alias("payment_method"),
        F.trim("status").alias("status"),
        blank_to_null(F.col("reversed_payment_id"))
        .try_cast("bigint")
        .alias("reversed_payment_id"),
    )


def typed_fx(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("currency").alias("currency"),
        strict(F.col("rate_date"), "date").alias("rate_date"),
        strict(F.col("units_per_usd"), USD).alias("fx_units_per_usd"),
    )


def fx_curves(
    fx: DataFrame, stored: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Curves:
    """Daily rates by currency."""
    return curves(fx, ["currency"], "rate_date", "fx_units_per_usd", stored)


# Entities


def dim_customer(raw_customers: DataFrame) -> DataFrame:
    """One row per person: the latest record, and how many ids the person has."""
    best = survivor(
        typed_customers(raw_customers),
        ["document_number"],
        ["created_at_utc", "customer_id"],
        "customer_id",
    )
    return best.select(
        "document_number",
        "country",
        "city",
        "email",
        "birth_year",
        "monthly_income",
        "created_at_utc",
        "customer_id_count",
    )


def dim_merchant(raw_history: DataFrame) -> DataFrame:
    return version_intervals(
        typed_merchants(raw_history), "merchant_id", "valid_from"
    ).select(
        "merchant_id",
        "merchant_name",
        "category",
        "country",
        "valid_from",
        "valid_to",
        "is_current",
    )


def fct_application(raw_changes: DataFrame, raw_customers: DataFrame) -> DataFrame:
    """Live applications in their final state, with the real customer id."""
    events = typed_application_events(raw_changes)
    state = latest_state(
        events,
        ["application_id"],
        EVENT_ORDER,
        created_at_utc=F.min("event_at_utc"),
    ).where("op <> 'D'")
    master = raw_customers.select(strict(F.col("customer_id"), "bigint").alias("customer_id"))
    known = known_id_per_key(
        events, "application_id", "customer_id", UNKNOWN_CUSTOMER, master
    )
    return repair_sentinel(
        state, known, "application_id", "customer_id", UNKNOWN_CUSTOMER
    ).select(
        "application_id",
        "customer_id",
        "merchant_id",
        "currency",
        "requested_amount",
        "approved_amount",
        "status",
        "created_at_utc",
        F.col("event_at_utc").alias("last_event_at_utc"),
        F.col("ingested_at_utc").alias("last_ingested_at_utc"),
    )


def valid_loans(raw_loans: DataFrame, applications: DataFrame) -> DataFrame:
    """Loans of approved applications; the customer is the application's."""
    approved = applications.where("status = 'APPROVED'").select(
        "application_id", "customer_id"
    )
    return typed_loans(raw_loans).join(approved, "application_id")


def fct_loan(raw_loans: DataFrame, applications: DataFrame, rates: Curves) -> DataFrame:
    loans = valid_loans(raw_loans, applications).withColumn(
        "disbursement_date", local_date(F.col("disbursed_at_utc"))
    )
    rated = look_up(loans, rates, ["currency"], "disbursement_date")
    return rated.select(
        "loan_id",
        "application_id",
        "customer_id",
        "merchant_id",
        "principal",
        "currency",
        "term_months",
        "apr",
        "disbursed_at_utc",
        "disbursement_date",
        "status",
        "fx_units_per_usd",
        to_usd(F.col("principal"), F.col("fx_units_per_usd")).alias("principal_usd"),
    )


def _dealt(rows: DataFrame, keys: Sequence[str], pieces: int | None) -> DataFrame:
    return rows.repartition(pieces, *keys) if pieces else rows.repartition(*keys)


def int_payment_history(raw_payments: DataFrame, pieces: int | None = None) -> DataFrame:
    """Settled payments with the instant of their earliest reversal, if any.

    Copies and reversals meet a payment in the same of ``pieces``: one shuffle does for
    both, and a task holds no more than its piece.
    """
    key = ["source_system", "payment_id"]
    events = typed_payment_events(raw_payments)
    settled = _dealt(events.where("status = 'SETTLED'"), key, pieces).distinct()
    reversals = (
        events.where("status = 'REVERSED' and reversed_payment_id is not null")
        .groupBy("source_system", F.col("reversed_payment_id").alias("payment_id"))
        .agg(F.min("paid_at_utc").alias("reversed_at_utc"))
    )
    return settled.join(reversals, key, "left").select(
        "source_system",
        "payment_id",
        "loan_id",
        "paid_at_utc",
        "amount",
        "payment_method",
        "reversed_at_utc",
    )


def fct_payment(history: DataFrame, loans: DataFrame) -> DataFrame:
    """Never-reversed payments of valid loans."""
    owners = loans.select("loan_id", "customer_id", "merchant_id", "currency")
    return (
        history.where("reversed_at_utc is null")
        .join(owners, "loan_id")
        .select(
            "source_system",
            "payment_id",
            "loan_id",
            "customer_id",
            "merchant_id",
            "currency",
            "paid_at_utc",
            local_date(F.col("paid_at_utc")).alias("paid_date"),
            "amount",
            "payment_method",
        )
    )


# Installment status


def int_installment_status(book: Ledger, shown: Shown | None = None) -> DataFrame:
    """Status of every installment at every month-end through the cutoff.

    ``shown`` may give the columns another form, see ``allocation_of``.
    """
    return allocation_of(book, shown=shown)


def fct_installment_status(book: Ledger) -> DataFrame:
    """Status at the cutoff only."""
    return final_status(allocation_of(book, final_only=True), book.cutoff)


def first_installment_status(book: Ledger) -> DataFrame:
    """Status at the cutoff of each loan's first installment, without the others."""
    return fct_installment_status(book.of(F.col("installment_number") == 1))


def final_status(status: DataFrame, cutoff: date) -> DataFrame:
    """The cutoff's rows of a month-end status table, with the settlement date."""
    return status.where(F.col("cutoff_date") == F.lit(cutoff)).select(
        "loan_id",
        "installment_number",
        "due_date",
        "amount_due",
        "paid_amount",
        "remaining_amount",
        "settlement_at_utc",
        local_date(F.col("settlement_at_utc")).alias("settlement_date"),
        "days_past_due",
    )


def loan_balances(status: DataFrame) -> DataFrame:
    """Unpaid balance and days past due per loan at one cutoff."""
    unpaid = F.col("remaining_amount") > 0
    return status.groupBy("loan_id").agg(
        F.sum("remaining_amount").alias("balance_local"),
        F.coalesce(F.max(F.when(unpaid, F.col("days_past_due"))), F.lit(0)).alias("dpd"),
    )


def first_payment_flags(first: DataFrame, cutoff: date) -> DataFrame:
    """Add ``eligible`` and ``defaulted`` to first installments at the cutoff."""
    age = F.datediff(F.lit(cutoff), F.col("due_date"))
    late = F.datediff("settlement_date", "due_date")
    defaulted = ((F.col("remaining_amount") > 0) & (age > 30)) | (
        (F.col("remaining_amount") == 0) & (late > 30)
    )
    return first.withColumn("eligible", age >= 30).withColumn("defaulted", defaulted)


# Reporting grains


def dm_loan_delinquency_snapshot(
    final: DataFrame, loans: DataFrame, rates: Curves, cutoff: date
) -> DataFrame:
    """Balance, days past due and bucket per loan at the cutoff."""
    owned = loan_balances(final).join(
        loans.select(
            "loan_id", "customer_id", "merchant_id", "currency", "disbursement_date"
        ),
        "loan_id",
    )
    rated = look_up(owned, rates, ["currency"], F.lit(cutoff))
    return rated.select(
        "loan_id",
        "customer_id",
        "merchant_id",
        "currency",
        "disbursement_date",
        F.col("balance_local").cast(MONEY).alias("balance_local"),
        to_usd(F.col("balance_local"), F.col("fx_units_per_usd"), MONEY).alias(
            "balance_usd"
        ),
        "dpd",
        bucket(F.col("dpd"), DPD_EDGES).alias("dpd_bucket"),
    )


def merchant_day_metrics(
    applications: DataFrame,
    loans: DataFrame,
    first: DataFrame,
    balances: DataFrame,
    rates: Curves,
    cutoff: date,
) -> DataFrame:
    """All merchant metrics summed per merchant and business date.

    ``first`` is the first installments' status at the cutoff, ``balances`` one row per
    loan and month-end. The date is the application, disbursement or snapshot date.
    Summing here, before any merchant version is looked up, leaves a hot merchant with
    at most one row per day and metric.
    """
    counted = applications.groupBy(
        "merchant_id", local_date(F.col("created_at_utc")).alias("day")
    ).agg(
        F.count("*").alias("n_applications"),
        F.count_if(F.col("status") == "APPROVED").alias("n_approved"),
    )
    disbursed = loans.groupBy("merchant_id", F.col("disbursement_date").alias("day")).agg(
        F.count("*").alias("n_loans"), F.sum("principal_usd").alias("gmv_usd")
    )
    flags = first_payment_flags(first, cutoff)
    defaults = (
        flags.join(loans.select("loan_id", "merchant_id", "disbursement_date"), "loan_id")
        .groupBy("merchant_id", F.col("disbursement_date").alias("day"))
        .agg(
            F.count_if("eligible").alias("fpd30_eligible"),
            F.count_if("defaulted").alias("fpd30_default"),
        )
    )
    owned = balances.join(loans.select("loan_id", "merchant_id", "currency"), "loan_id")
    balance = look_up(owned, rates, ["currency"], "cutoff_date").select(
        "merchant_id",
        F.col("cutoff_date").alias("day"),
        "dpd",
        to_usd(F.col("balance_local"), F.col("fx_units_per_usd")).alias("usd"),
    )
    outstanding = balance.groupBy("merchant_id", "day").agg(
        F.sum("usd").alias("outstanding_usd"),
        F.sum(F.when(F.col("dpd") > 30, F.col("usd"))).alias("outstanding_dpd_gt_30_usd"),
    )
    united = counted
    for part in (disbursed, defaults, outstanding):
        united = united.unionByName(part, allowMissingColumns=True)
    metrics = [c for c in united.columns if c not in ("merchant_id", "day")]
    return united.groupBy("merchant_id", "day").agg(*[F.sum(c).alias(c) for c in metrics])


def agg_merchant_monthly(daily: DataFrame, merchants: DataFrame) -> DataFrame:
    """Merchant-month report from the daily metrics.

    Each day counts once per merchant version valid on it, so days before the
    first version drop out. A month appears if any metric has rows for it.
    """
    dated = interval_join(daily, merchants, "merchant_id", "day").withColumn(
        "month", month_start(F.col("day"))
    )
    metrics = [c for c in daily.columns if c not in ("merchant_id", "day")]
    sums = dated.groupBy("merchant_id", "month").agg(*[F.sum(c).alias(c) for c in metrics])

    def count(name: str):
        return F.coalesce(name, F.lit(0)).alias(name)

    def usd(name: str):
        return F.round(F.col(name), 2).cast(MONEY)

    def usd_or_zero(name: str):
        return F.coalesce(usd(name), F.lit(0).cast(MONEY)).alias(name)

    return sums.select(
        "merchant_id",
        "month",
        count("n_applications"),
        count("n_approved"),
        ratio(F.col("n_approved"), F.col("n_applications")).alias("approval_rate"),
        count("n_loans"),
        usd_or_zero("gmv_usd"),
        count("fpd30_eligible"),
        count("fpd30_default"),
        ratio(F.col("fpd30_default"), F.col("fpd30_eligible")).alias("fpd30_rate"),
        usd_or_zero("outstanding_usd"),
        usd_or_zero("outstanding_dpd_gt_30_usd"),
        # No delinquent balance is a rate of zero; no portfolio is no rate.
        ratio(
            usd_or_zero("outstanding_dpd_gt_30_usd"), usd("outstanding_usd")
        ).alias("par30_rate"),
    )


class Lending:
    """The tables over one set of text extracts, for one cutoff.

    ``raw`` maps extract names to frames. Tables that several others read are
    stored once per instance; the rest stay lazy. Loans, plan and paid days are stored
    in buckets by loan, so what follows per loan needs no shuffle.
    """

    def __init__(self, raw: Mapping[str, DataFrame], cutoff: date, layers: Layers):
        self.raw = raw
        self.cutoff = require_month_end(cutoff)
        self.layers = layers
        self._plan: DataFrame | None = None

    def _silver(self, name: str, df: DataFrame) -> DataFrame:
        return self.layers.write(df, "silver", name)

    def _by_loan(self, name: str, df: DataFrame) -> DataFrame:
        return self.layers.write_bucketed(df, "silver", name, "loan_id", self.pieces)

    @cached_property
    def pieces(self) -> int:
        """Pieces of payments and buckets of loans, by the rows of the largest extracts."""
        largest = ("raw_payments", "raw_installments")
        return pieces_for(self.layers.spark, max(self.raw[n].count() for n in largest))

    def store(self) -> None:
        """Stores the tables that others read now; otherwise each is at its first use."""
        for name in ("stored_application", "stored_loan", "stored_payment_history", "ledger"):
            getattr(self, name)

    @cached_property
    def fx(self) -> DataFrame:
        return typed_fx(self.raw["raw_fx_rates"])

    @cached_property
    def rates(self) -> Curves:
        return fx_curves(self.fx, lambda df: self._silver("fx_curves", df))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dim_customer(self.raw["raw_customers"])

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return dim_merchant(self.raw["raw_merchants_history"])

    @cached_property
    def fct_application(self) -> DataFrame:
        return fct_application(
            self.raw["raw_applications_cdc"], self.raw["raw_customers"]
        )

    @cached_property
    def stored_application(self) -> DataFrame:
        return self._silver("fct_application", self.fct_application)

    @cached_property
    def fct_loan(self) -> DataFrame:
        return fct_loan(self.raw["raw_loans"], self.fct_application, self.rates)

    @cached_property
    def stored_loan(self) -> DataFrame:
        loans = fct_loan(self.raw["raw_loans"], self.stored_application, self.rates)
        return self._by_loan("fct_loan", loans)

    @cached_property
    def int_payment_history(self) -> DataFrame:
        return int_payment_history(self.raw["raw_payments"], self.pieces)

    @cached_property
    def stored_payment_history(self) -> DataFrame:
        return self._silver("int_payment_history", self.int_payment_history)

    @cached_property
    def fct_payment(self) -> DataFrame:
        return fct_payment(self.int_payment_history, self.stored_loan)

    @cached_property
    def ledger(self) -> Ledger:
        return self.ledger_at(self.cutoff)

    def ledger_at(self, cutoff: date) -> Ledger:
        """The ledger through a month-end, stored."""
        suffix = f"{cutoff:%Y%m%d}"
        book = ledger(
            self.stored_loan,
            typed_installments(self.raw["raw_installments"]),
            self.stored_payment_history,
            require_month_end(cutoff),
            bucketed=lambda df, name: self._by_loan(f"{name}_{suffix}", df),
            stored=lambda df, name: self._silver(f"{name}_{suffix}", df),
            plan=self._plan,
            pieces=self.pieces,
        )
        self._plan = book.plan
        return book

    @cached_property
    def int_installment_status(self) -> DataFrame:
        return int_installment_status(self.ledger)

    @cached_property
    def fct_installment_status(self) -> DataFrame:
        return fct_installment_status(self.ledger)

    @cached_property
    def first_installment_status(self) -> DataFrame:
        return first_installment_status(self.ledger)

    @cached_property
    def dm_loan_delinquency_snapshot(self) -> DataFrame:
        final = allocation_of(self.ledger, final_only=True, with_settlement=False)
        return dm_loan_delinquency_snapshot(
            final, self.stored_loan, self.rates, self.cutoff
        )

    @cached_property
    def merchant_day_metrics(self) -> DataFrame:
        return merchant_day_metrics(
            self.stored_application,
            self.stored_loan,
            self.first_installment_status,
            balances_of(self.ledger),
            self.rates,
            self.cutoff,
        )

    @cached_property
    def agg_merchant_monthly(self) -> DataFrame:
        return agg_merchant_monthly(self.merchant_day_metrics, self.dim_merchant)
