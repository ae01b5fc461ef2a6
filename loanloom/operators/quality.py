"""Data-quality checks. Each returns the violating rows; none means it passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A table broke a rule that its reader insists on."""


def require_none(violations: DataFrame, rule: str) -> None:
    """Raise when a check returned anything; shows a few of the rows."""
    shown = violations.take(3)
    if shown:
        raise QualityError(f"{rule}: {[row.asDict() for row in shown]}")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-null values of one column."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def between_0_and_1(df: DataFrame, column: str) -> DataFrame:
    return df.where((F.col(column) < 0) | (F.col(column) > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row count; null passes."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
    )


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference both ways; empty means the tables are equal.

    Rows are counted per distinct row and side in one aggregate, so a row copied
    a billion times is one row after the map side.
    """
    columns = left.columns
    both = left.withColumn("_n", F.lit(1)).unionByName(
        right.select(columns).withColumn("_n", F.lit(-1))
    )
    net = both.groupBy(*columns).agg(F.sum("_n").alias("_net")).where("_net <> 0")
    return net.select(
        *columns,
        F.when(F.col("_net") > 0, "left").otherwise("right").alias("only_in"),
        F.abs("_net").alias("n_rows"),
    )


def overlapping_or_gapped(versions: DataFrame, key: str) -> DataFrame:
    """Versions that do not start exactly where the previous one ended.

    Stated without a window so it also judges intervals written elsewhere: every
    start but the first must be some version's end, and every end a start.
    """
    first = F.min("valid_from").alias("first_from")
    starts = versions.select(key, F.col("valid_from").alias("edge"), F.lit(1).alias("s"))
    ends = versions.where("valid_to is not null").select(
        key, F.col("valid_to").alias("edge"), F.lit(-1).alias("s")
    )
    edges = (
        starts.unionByName(ends)
        .groupBy(key, "edge")
        .agg(F.sum("s").alias("balance"))
        .where("balance <> 0")
    )
    origin = versions.groupBy(key).agg(first)
    return (
        edges.join(origin, key)
        .where(~((F.col("edge") == F.col("first_from")) & (F.col("balance") == 1)))
        .select(key, "edge", "balance")
    )


def reversal_violations(events: DataFrame) -> DataFrame:
    """Reversal targets without exactly one settled payment, or reversed twice.

    ``events`` holds distinct (source_system, payment_id, status,
    reversed_payment_id). Both sides are counted under the target's key in one
    aggregate; no join is needed.
    """
    reversal = F.col("status") == "REVERSED"
    target = F.when(reversal, F.col("reversed_payment_id")).otherwise(
        F.col("payment_id")
    )
    counted = (
        events.where(F.col("status").isin("SETTLED", "REVERSED"))
        .select("source_system", target.alias("payment_id"), "status")
        .groupBy("source_system", "payment_id")
        .agg(
            F.count_if(F.col("status") == "REVERSED").alias("n_reversals"),
            # A null key matches no settled payment.
            F.count_if(
                (F.col("status") == "SETTLED")
                & F.col("payment_id").isNotNull()
                & F.col("source_system").isNotNull()
            ).alias("n_settled"),
        )
    )
    return counted.where(
        (F.col("n_reversals") > 0)
        & ((F.col("n_settled") != 1) | (F.col("n_reversals") > 1))
    )


def source_profile(df: DataFrame, name: str, **flags: Column) -> DataFrame:
    """Rows, exact duplicates and how often each named condition holds, one per row.

    Duplicates are folded by a grouped count first, so every stage combines
    before it shuffles.
    """
    folded = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    copies = F.col("_copies")
    measures = {
        "n_rows": F.sum(copies),
        "n_duplicates": F.sum(copies) - F.count("*"),
        **{label: F.sum(F.when(flag, copies)) for label, flag in flags.items()},
    }
    totals = folded.agg(*[m.alias(label) for label, m in measures.items()])
    pairs = [
        F.struct(
            F.lit(label).alias("measure"), F.coalesce(label, F.lit(0)).alias("n")
        )
        for label in measures
    ]
    return totals.select(F.lit(name).alias("source"), F.inline(F.array(*pairs)))


def mixed_styles(df: DataFrame, keys: Sequence[str], style: Column) -> DataFrame:
    """Keys whose rows write the same kind of value in more than one style."""
    return (
        df.groupBy(*keys)
        .agg(F.min(style).alias("_low"), F.max(style).alias("_high"))
        .where("_low <> _high")
        .select(*keys)
    )


def reconcile(**sides: DataFrame) -> DataFrame:
    """One row per named one-row frame of ``expected`` and ``actual``, and whether equal."""
    rows = None
    for name, side in sides.items():
        row = side.select(
            F.lit(name).alias("rule"),
            F.col("expected").cast("decimal(38,2)").alias("expected"),
            F.col("actual").cast("decimal(38,2)").alias("actual"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows.withColumn("agrees", F.col("expected") == F.col("actual"))


def fifo_violations(status: DataFrame, received: DataFrame) -> DataFrame:
    """Loans and month-ends where the allocation lost money or broke the order.

    ``received`` has what counts of each valid loan's payments at each month-end.
    The rules are those of ``fifo_violations_by_step``.
    """
    per_loan = _fifo_sums(status, ["cutoff_date", "loan_id"])
    paid_in = received.withColumnRenamed("amount", "_received")
    judged = per_loan.join(paid_in, ["cutoff_date", "loan_id"], "left")
    return judged.select("cutoff_date", "loan_id", F.explode(_fifo_rules()).alias("rule"))


def fifo_violations_by_step(status: DataFrame, received: DataFrame) -> DataFrame:
    """Loans and steps ``[step_from, step_to)`` where the allocation went wrong.

    ``received`` has what counts of each valid loan's payments, in steps as well; it may
    not change inside a step of ``status``, as is so for steps of one ledger.

    ``row``: a negative amount, paid + remaining ≠ due, or a later installment
    paid while an earlier one is open. ``total``: the allocated sum is not the
    smaller of what is due and what was effectively paid.

    The order rule needs no window: it is broken exactly when the last installment
    with a payment comes after the first one still open.
    """
    per_loan = _fifo_sums(status, ["step_from", "step_to", "loan_id"])
    # Only the loan is compared for equality, so tables dealt by it stay where they are.
    paid_in = received.select(
        F.col("loan_id").alias("_loan"),
        F.col("step_from").alias("_from"),
        F.col("step_to").alias("_to"),
        F.col("amount").alias("_received"),
    )
    during = (
        (F.col("loan_id") == F.col("_loan"))
        & (F.col("_from") <= F.col("step_from"))
        & (F.col("step_from") < F.col("_to"))
    )
    return per_loan.join(paid_in, during, "left").select(
        "step_from", "step_to", "loan_id", F.explode(_fifo_rules()).alias("rule")
    )


def _fifo_sums(status: DataFrame, keys: Sequence[str]) -> DataFrame:
    number = F.col("installment_number")
    paid, left, due = (
        F.col("paid_amount"),
        F.col("remaining_amount"),
        F.col("amount_due"),
    )
    bad = (paid < 0) | (left < 0) | (F.abs(paid + left - due) > 0.005)
    return status.groupBy(*keys).agg(
        F.bool_or(bad).alias("_bad"),
        F.max(F.when(paid > 0, number)).alias("_last_paid"),
        F.min(F.when(left > 0.005, number)).alias("_first_open"),
        F.sum("amount_due").alias("_due"),
        F.sum("paid_amount").alias("_paid"),
    )


def _fifo_rules() -> Column:
    """Names of the broken rules, from the sums and ``_received``."""
    expected = F.least("_due", F.coalesce("_received", F.lit(0)))
    off = F.abs(F.col("_paid") - expected) > 0.005
    row = F.col("_bad") | F.coalesce(
        F.col("_last_paid") > F.col("_first_open"), F.lit(False)
    )
    return F.array_compact(
        F.array(F.when(row, F.lit("row")), F.when(off, F.lit("total")))
    )
