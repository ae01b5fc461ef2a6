from datetime import date, datetime
from decimal import Decimal

import pytest

from loanloom.operators import quality as q
from loanloom.operators.allocation import (
    allocate,
    amounts_by_step,
    ledger,
    month_ends_of_step,
    received_of,
    received_steps_of,
)
from loanloom.operators.temporal import version_intervals
from pyspark.sql import functions as F
from test_operators import CUTOFF, frames


def test_each_check_passes_and_fires(spark):
    good = spark.createDataFrame([(1, "a", 0.5), (2, "b", None)], "id int, k string, v double")
    bad = spark.createDataFrame(
        [(1, "a", -0.5), (1, "a", 1.5), (None, "c", 0.1), (None, None, 1.0)],
        "id int, k string, v double",
    )
    checks = {
        "unique": (lambda df: q.unique(df, "id"), 1),
        "unique_combination": (lambda df: q.unique_combination(df, ["id", "k"]), 1),
        "not_null": (lambda df: q.not_null(df, "id"), 2),
        "not_negative": (lambda df: q.not_negative(df, "v"), 1),
        "between_0_and_1": (lambda df: q.between_0_and_1(df, "v"), 2),
        "accepted_values": (lambda df: q.accepted_values(df, "k", ["a", "b"]), 1),
        "relationships": (lambda df: q.relationships(df, "k", good, "k"), 1),
    }
    for name, (check, n) in checks.items():
        assert check(good).count() == 0, name
        assert check(bad).count() == n, name
    q.require_none(q.unique(good, "id"), "id is unique")
    with pytest.raises(q.QualityError, match="id is unique"):
        q.require_none(q.unique(bad, "id"), "id is unique")


def test_table_diff_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([("x", 2), (None, 1), ("y", 3)], "b string, a int")
    got = {tuple(r) for r in q.table_diff(left, right).collect()}
    assert got == {(1, None, "left", 1), (3, "y", "right", 1)}
    assert q.table_diff(left, left).isEmpty()


def test_versions(spark):
    history = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (1, date(2024, 2, 1)), (1, date(2024, 3, 1)), (2, date(2024, 1, 1))],
        "m int, valid_from date",
    )
    versions = version_intervals(history, "m", "valid_from")
    assert q.overlapping_or_gapped(versions, "m").isEmpty()
    gap = versions.where("not (m = 1 and valid_from = date'2024-02-01')")
    assert {r.edge for r in q.overlapping_or_gapped(gap, "m").collect()} == {
        date(2024, 2, 1),
        date(2024, 3, 1),
    }


def test_reversals(spark):
    rows = [
        ("a", 1, "SETTLED", None), ("a", 10, "REVERSED", 1),  # fine
        ("a", 2, "SETTLED", None), ("a", 20, "REVERSED", 2), ("a", 21, "REVERSED", 2),  # twice
        ("b", 30, "REVERSED", 1),  # target only in the other system
        ("a", 40, "REVERSED", None),  # no target
        ("a", 5, "SETTLED", None),
    ]
    events = spark.createDataFrame(
        rows, "source_system string, payment_id long, status string, reversed_payment_id long"
    )
    got = {(r.source_system, r.payment_id) for r in q.reversal_violations(events).collect()}
    assert got == {("a", 2), ("b", 1), ("a", None)}


def test_fifo_conservation(spark):
    case = (
        [(1, date(2024, 3, 1)), (2, date(2024, 3, 1))],
        [(n, i, date(2024, 3 + i, 1), Decimal(10)) for n in (1, 2) for i in (1, 2)],
        [("a", 1, 1, datetime(2024, 4, 2, 12), Decimal(15), None)],
    )
    loans, plan, payments = frames(spark, case)
    status = allocate(loans, plan, payments, CUTOFF, final_only=True)
    received = received_of(ledger(loans, plan, payments, CUTOFF))
    assert q.fifo_violations(status, received).isEmpty()
    # The second installment paid while the first is open.
    swapped = status.withColumn(
        "paid_amount",
        F.when(F.col("loan_id") == 1, 15 - F.col("paid_amount")).otherwise(F.col("paid_amount")),
    ).withColumn("remaining_amount", F.col("amount_due") - F.col("paid_amount"))
    found = q.fifo_violations(swapped, received).collect()
    assert [(r.loan_id, r.rule) for r in found] == [(1, "row")]
    lost = payments.withColumn("amount", F.col("amount") + 1)
    received = received_of(ledger(loans, plan, lost, CUTOFF))
    found = q.fifo_violations(status, received).collect()
    assert [(r.loan_id, r.rule) for r in found] == [(1, "total")]


def test_fifo_by_step_finds_what_the_month_ends_show(planned):
    """Also for a loan id with two disbursements; no row per month-end is made before."""
    case = (
        [(1, date(2024, 1, 5)), (1, date(2024, 3, 9)), (2, date(2024, 2, 1)), (3, date(2024, 1, 2))],
        [(n, i, date(2024, 1 + i, 1), Decimal(10)) for n in (1, 2, 3) for i in (1, 2, 3)],
        [
            ("a", 1, 1, datetime(2024, 2, 2, 12), Decimal(15), datetime(2024, 5, 3, 12)),
            ("a", 2, 1, datetime(2024, 4, 2, 12), Decimal(40), None),
            ("a", 3, 2, datetime(2024, 3, 2, 12), Decimal(12), None),
        ],
    )
    loans, plan, payments = frames(planned, case)

    def broken(status):
        wrong = F.col("installment_number") == 2
        return status.withColumns(
            {
                "paid_amount": F.when(wrong, F.col("paid_amount") + 1).otherwise(F.col("paid_amount")),
                "remaining_amount": F.when(wrong, 5).otherwise(F.col("remaining_amount")),
            }
        )

    book = ledger(loans, plan, payments, CUTOFF)
    monthly = q.fifo_violations(
        broken(allocate(loans, plan, payments, CUTOFF, with_settlement=False)), received_of(book)
    )
    steps = q.fifo_violations_by_step(broken(amounts_by_step(book)), received_steps_of(book))
    spread = month_ends_of_step(steps).select(*monthly.columns)
    expected = sorted(map(tuple, monthly.collect()))
    assert sorted(map(tuple, spread.collect())) == expected and len(expected) > 10
    assert "Generate explode(sequence" not in steps._jdf.queryExecution().optimizedPlan().toString()
