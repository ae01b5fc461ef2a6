"""Full refresh of all layers, the declared checks, and the exported answers."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanloom.operators import quality as q
from loanloom.operators.allocation import Ledger, balances_of, received_of
from loanloom.plans import answers
from loanloom.plans import lending as plans
from loanloom.sources.bronze import read_extracts
from loanloom.sources.export import export_answer, export_table
from loanloom.sources.layers import Layers

# Accepted categories, and the columns each check applies to.
MERCHANT_CATEGORIES = (
    "EDUCATION",
    "ELECTRONICS",
    "FASHION",
    "HEALTH",
    "HOME",
    "MOTORCYCLES",
    "TRAVEL",
    "UNKNOWN",
)
NOT_NULL = {
    "dim_customer": ("document_number",),
    "dim_merchant": ("merchant_id", "valid_from"),
    "fct_application": ("application_id",),
    "fct_loan": ("loan_id", "principal_usd"),
    "int_payment_history": ("source_system", "payment_id"),
    "fct_payment": ("source_system", "payment_id"),
    "int_installment_status": ("cutoff_date", "loan_id", "installment_number"),
    "fct_installment_status": ("loan_id", "installment_number"),
    "agg_merchant_monthly": ("merchant_id", "month"),
    "dm_loan_delinquency_snapshot": ("loan_id", "balance_usd"),
}
GRAIN = {
    "dim_customer": ("document_number",),
    "dim_merchant": ("merchant_id", "valid_from"),
    "fct_application": ("application_id",),
    "fct_loan": ("loan_id",),
    "int_payment_history": ("source_system", "payment_id"),
    "fct_payment": ("source_system", "payment_id"),
    "int_installment_status": ("cutoff_date", "loan_id", "installment_number"),
    "fct_installment_status": ("loan_id", "installment_number"),
    "agg_merchant_monthly": ("merchant_id", "month"),
    "dm_loan_delinquency_snapshot": ("loan_id",),
}
ACCEPTED = {
    ("dim_merchant", "category"): MERCHANT_CATEGORIES,
    ("fct_application", "status"): ("APPROVED", "REJECTED"),
    ("fct_loan", "currency"): ("COP", "BRL"),
    ("fct_loan", "status"): ("DISBURSED",),
    ("int_payment_history", "source_system"): ("legacy_v1", "core_v2"),
    ("dm_loan_delinquency_snapshot", "dpd_bucket"): ("0", "1-30", "31-60", "61-90", "90+"),
}
PARENTS = {
    ("fct_loan", "application_id"): "fct_application",
    ("fct_payment", "loan_id"): "fct_loan",
    ("int_installment_status", "loan_id"): "fct_loan",
    ("fct_installment_status", "loan_id"): "fct_loan",
}
NOT_NEGATIVE = {
    "fct_loan": "principal_usd",
    "int_payment_history": "amount",
    "int_installment_status": "remaining_amount",
    "fct_installment_status": "remaining_amount",
    "dm_loan_delinquency_snapshot": "balance_usd",
}
RATES = ("approval_rate", "fpd30_rate", "par30_rate")


def row_rules() -> dict[str, dict[str, Column]]:
    """Per table the rules that one row breaks by itself: rule name and its condition."""
    rules: dict[str, dict[str, Column]] = {name: {} for name in NOT_NULL}
    for name, columns in NOT_NULL.items():
        for column in columns:
            rules[name][f"not_null {name}.{column}"] = F.col(column).isNull()
    for (name, column), values in ACCEPTED.items():
        outside = F.col(column).isNotNull() & ~F.col(column).isin(*values)
        rules[name][f"accepted {name}.{column}"] = outside
    for name, column in NOT_NEGATIVE.items():
        rules[name][f"not_negative {name}.{column}"] = F.col(column) < 0
    for column in RATES:
        rate = F.col(column)
        rules["agg_merchant_monthly"][f"rate {column}"] = (rate < 0) | (rate > 1)
    return rules


def breaches(rules: Mapping[str, Column]) -> list[Column]:
    """Rows that break each rule, as aggregates by the rule's name."""
    return [F.count_if(rule).alias(name) for name, rule in rules.items()]


def broken_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, counted in one pass over the table."""
    counts = df.agg(*breaches(rules))
    pairs = [
        F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("n_violations"))
        for name in rules
    ]
    return counts.select(F.inline(F.array(*pairs)))


def checks(
    tables: Mapping[str, DataFrame], raw: Mapping[str, DataFrame], book: Ledger
) -> dict[str, DataFrame]:
    """Violations of the declared rules that need several rows or tables, by rule name."""
    found: dict[str, DataFrame] = {}
    for name, columns in GRAIN.items():
        found[f"unique {name}"] = q.unique_combination(tables[name], columns)
    for (name, column), parent in PARENTS.items():
        found[f"parent {name}.{column}"] = q.relationships(
            tables[name], column, tables[parent], column
        )
    events = plans.typed_payment_events(raw["raw_payments"]).select(
        "source_system", "payment_id", "status", "reversed_payment_id"
    )
    found["reversals resolve"] = q.reversal_violations(events.distinct())
    found["fifo conserves"] = q.fifo_violations(
        tables["int_installment_status"], received_of(book)
    )
    return found


def violation_counts(violations: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named check."""
    counts = [
        df.agg(F.count("*").alias("n_violations")).select(
            F.lit(name).alias("rule"), "n_violations"
        )
        for name, df in violations.items()
    ]
    return reduce(DataFrame.unionByName, counts)


class CheckedLayers(Layers):
    """Stored tables whose rules on single rows are counted by the job that writes them.

    ``broken`` has the counts of the tables written so far.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        super().__init__(spark, root)
        self.broken: dict[str, int] = {}

    def _written(self, df: DataFrame, name: str, save: Callable[[DataFrame], None]) -> None:
        rules = row_rules().get(name)
        if not rules:
            return super()._written(df, name, save)
        seen = Observation(f"rules of {name}")
        save(df.observe(seen, *breaches(rules)))
        found = seen.get
        # A table without rows reports nothing.
        self.broken |= {rule: found.get(rule) or 0 for rule in rules}


def store_tables(
    raw: Mapping[str, DataFrame], layers: Layers, cutoff: date
) -> tuple[dict[str, DataFrame], Ledger]:
    """Replace all silver and gold tables; each is computed from stored ones."""
    t = plans.Lending(raw, cutoff, layers)
    loans, history = t.stored_loan, t.stored_payment_history
    tables: dict[str, DataFrame] = {
        "fct_application": t.stored_application,
        "fct_loan": loans,
        "int_payment_history": history,
        "dim_customer": layers.write(t.dim_customer, "silver", "dim_customer"),
        "dim_merchant": layers.write(t.dim_merchant, "silver", "dim_merchant"),
        "fct_payment": layers.write(
            plans.fct_payment(history, loans), "silver", "fct_payment"
        ),
    }
    status = layers.write(
        plans.int_installment_status(t.ledger),
        "silver",
        "int_installment_status",
        ["cutoff_date"],
    )
    final = layers.write_bucketed(
        plans.final_status(status, cutoff), "silver", "fct_installment_status", "loan_id"
    )
    # From the paid days: the month-end table is far larger than its balances.
    daily = plans.merchant_day_metrics(
        tables["fct_application"],
        loans,
        final.where("installment_number = 1"),
        balances_of(t.ledger),
        t.rates,
        cutoff,
    )
    report = plans.agg_merchant_monthly(daily, tables["dim_merchant"])
    snapshot = plans.dm_loan_delinquency_snapshot(final, loans, t.rates, cutoff)
    tables |= {
        "int_installment_status": status,
        "fct_installment_status": final,
        "agg_merchant_monthly": layers.write(report, "gold", "agg_merchant_monthly"),
        "dm_loan_delinquency_snapshot": layers.write_bucketed(
            snapshot, "gold", "dm_loan_delinquency_snapshot", "loan_id"
        ),
    }
    return tables, t.ledger


def all_answers(
    tables: Mapping[str, DataFrame], cutoff: date, cohort: date
) -> dict[str, DataFrame]:
    loans, final = tables["fct_loan"], tables["fct_installment_status"]
    return {
        "q1_applications_approval": answers.applications_approval(tables["fct_application"]),
        "q2_loans_gmv": answers.loans_gmv(loans),
        "q3_cohort_gmv": answers.cohort_gmv(loans, cohort),
        "q4_fpd30": answers.fpd30(final, loans, cutoff, cohort),
        "q5_par30_balance": answers.par30(tables["dm_loan_delinquency_snapshot"]),
        "q6_merchant_concentration": answers.merchant_concentration(loans),
        "q7_redundant_ids": answers.redundant_ids(tables["dim_customer"]),
    }


def build(
    spark: SparkSession, source: str, target: str, cutoff: date, cohort: date
) -> dict[str, int]:
    """Load the extracts, refresh every table, export, and judge the rules.

    Returns the violation count of every rule; the caller decides what to refuse.
    """
    layers = CheckedLayers(spark, target)
    raw = {
        name: layers.write(df, "bronze", name)
        for name, df in read_extracts(spark, source).items()
    }
    tables, book = store_tables(raw, layers, cutoff)
    for name, df in all_answers(tables, cutoff, cohort).items():
        order = ["gmv_rank"] if name.startswith("q6") else []
        export_answer(df, layers.path("exports", name), order)
    for name in ("agg_merchant_monthly", "dm_loan_delinquency_snapshot"):
        export_table(tables[name], layers.path("exports", name), GRAIN[name])
    # One row per rule.
    counts = violation_counts(checks(tables, raw, book)).collect()
    layers.close()
    return {row["rule"]: row["n_violations"] for row in counts} | layers.broken
