import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from loanloom.sources.layers import Layers, pieces_for
from pyspark.sql import functions as F

from loanloom.catalog import all_queries, present
from loanloom.operators.allocation import (
    allocate,
    allocation_of,
    balances_by_month_end,
    effective_by_month_end,
    ledger,
    received_by_month_end,
)
from loanloom.operators.change_log import known_id_per_key, latest_state, repair_sentinel
from loanloom.operators.quality import table_diff
from loanloom.operators import temporal
from loanloom.operators.running import in_pieces, running_total, with_position
from loanloom.operators.temporal import asof_join, interval_join, version_intervals
from loanloom.plans.lending import final_status, int_payment_history

from conftest import FOLDER

CUTOFF = date(2024, 6, 30)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_asof(planned):
    series = planned.createDataFrame(
        [("A", date(2024, 1, 5), 1), ("A", date(2024, 1, 8), 2), ("B", date(2024, 1, 5), 7)],
        "k string, d date, v int",
    )
    asked = [
        ("A", date(2024, 1, 4), None),
        ("A", date(2024, 1, 5), 1),
        ("A", date(2024, 1, 7), 1),
        ("A", date(2024, 1, 8), 2),
        ("A", date(2030, 1, 1), 2),
        ("B", date(2024, 1, 6), 7),
        ("C", date(2024, 1, 6), None),
        (None, date(2024, 1, 6), None),
        ("A", None, None),
    ]
    left = planned.createDataFrame([a[:2] for a in asked], "key string, day date")
    got = asof_join(left, series, {"key": "k"}, "day", "d", "v")
    assert rows(got) == sorted(asked, key=str)


def test_interval_join(planned):
    history = planned.createDataFrame(
        [(1, date(2024, 1, 1), "x"), (1, date(2024, 2, 1), "y"), (2, date(2024, 1, 1), "z")],
        "m int, valid_from date, c string",
    )
    versions = version_intervals(history, "m", "valid_from")
    events = planned.createDataFrame(
        [(1, date(2023, 12, 31)), (1, date(2024, 1, 1)), (1, date(2024, 2, 1)), (2, date(2025, 1, 1))],
        "m int, day date",
    )
    got = interval_join(events, versions, "m", "day").select("m", "day", "c")
    assert rows(got) == [
        (1, date(2024, 1, 1), "x"),
        (1, date(2024, 2, 1), "y"),
        (2, date(2025, 1, 1), "z"),
    ]


def test_latest_state_and_sentinel(planned):
    log = planned.createDataFrame(
        [
            (1, 999, "I", 1), (1, 5, "U", 2), (1, 5, "U", 2), (1, 999, "U", 3),
            (2, 999, "I", 1),
            (3, 999, "I", 1), (3, 77, "U", 2), (3, 999, "U", 3),
            (4, 6, "I", None), (4, 8, "U", 1),
        ],
        "app int, cust int, op string, at int",
    )
    last = latest_state(log, ["app"], ["at", "op"], first_at=F.min("at"))
    master = planned.createDataFrame([(5,), (6,), (8,)], "cust int")
    known = known_id_per_key(log, "app", "cust", 999, master)
    got = repair_sentinel(last, known, "app", "cust", 999).select("app", "cust", "at", "first_at")
    # 77 is not in the master; a null time is older than any.
    assert rows(got) == [(1, 5, 3, 1), (2, None, 1, 1), (3, None, 3, 1), (4, 8, 1, 1)]


def pieces_of(spark):
    layers = Layers(spark)
    return lambda df: layers.write(df, "silver", "pieces")


def test_pieces_bound_a_hot_day(spark):
    """Nine rows in ten are one key's of one day; no piece is twice the mean."""
    df = spark.range(20_000).selectExpr(
        "if(id % 10 = 0, concat('k', id % 70), 'hot') as k",
        "if(id % 10 = 0, id % 9, 5) as t",
        "id",
        "id % 7 as v",
    )
    stored = pieces_of(spark)
    order = [F.col("k"), F.col("t"), F.col("id")]
    # So few rows would be put into one or two pieces.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    counted = in_pieces(df, order, stored).groupBy("_piece").count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in counted]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    got = running_total(df, ["k"], ["t", "id"], "v", stored).where("k = 'hot'").orderBy("id")
    total = 0
    for r in got.collect():
        assert (r["before"], r["after"]) == (total, total + r["v"])
        total += r["v"]


def test_positions(planned):
    rng = random.Random(4)
    data = [(rng.randrange(50) or None, i) for i in range(500)]
    df = planned.createDataFrame(data, "t int, id int").repartition(5)
    order = [F.col("t").asc_nulls_last(), F.col("id")]
    got = with_position(df, order, pieces_of(planned)).collect()
    expected = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert sorted((r.position, r.t, r.id) for r in got) == [
        (n, *r) for n, r in enumerate(expected, 1)
    ]
    assert with_position(df.limit(0), order, pieces_of(planned)).count() == 0


def test_asof_without_broadcast_spreads_a_hot_key(planned, monkeypatch):
    """Beyond the counted size each key is joined by salts, with equal results."""
    monkeypatch.setattr(temporal, "SALTS", 8)
    series = planned.createDataFrame(
        [("a", date(2024, 1, d), float(d)) for d in (2, 5, 9)] + [("b", date(2024, 1, 3), 7.0)],
        "k string, d date, v double",
    )
    left = planned.range(4000).selectExpr(
        "if(id % 10 = 0, 'b', if(id = 7, 'c', if(id = 9, null, 'a'))) as key",
        "date_add(date'2023-12-30', cast(id % 20 as int)) as day",
        "id",
    ).repartition(4)
    found = temporal.curves(series, ["k"], "d", "v")
    assert found.size == 9
    small = temporal.look_up(left, found, ["key"], "day")
    salted = temporal.look_up(left, found, ["key"], "day", most_values=0)
    assert rows(small) == rows(salted)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    salts = left.withColumn("s", F.monotonically_increasing_id() % 8).groupBy("key", "s").count()
    assert salts.agg(F.max("count")).first()[0] < 2 * 3600 / 8


def test_running_total_matches_plain_sum(planned):
    rng = random.Random(3)
    # One key holds most rows, and many rows share an instant.
    data = [
        ("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", rng.randrange(60), i, rng.randrange(9))
        for i in range(400)
    ]
    df = planned.createDataFrame(data, "k string, t int, id int, v int")
    got = running_total(df, ["k"], ["t", "id"], "v", pieces_of(planned))
    expected, sums = [], defaultdict(int)
    for k, t, i, value in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        expected.append((k, t, i, value, sums[k], sums[k] + value))
        sums[k] += value
    assert rows(got) == sorted(expected, key=str)


def month_ends(first):
    day, found = first, []
    while day <= CUTOFF:
        after = (day.replace(day=1) + timedelta(days=32)).replace(day=1)
        found.append(after - timedelta(days=1))
        day = after
    return found


def expected_status(loans, plan, payments):
    """Allocation by its definition, one month-end and payment at a time."""
    out = []
    local = lambda ts: (ts - timedelta(hours=5)).date()
    for loan, start in loans:
        for cutoff in month_ends(start):
            live = sorted(
                (p for p in payments if p[2] == loan and local(p[3]) <= cutoff
                 and (p[5] is None or local(p[5]) > cutoff)),
                key=lambda p: (p[3], p[0], p[1]),
            )
            total, before = sum((p[4] for p in live), Decimal(0)), Decimal(0)
            for _, number, due_date, due in sorted(
                (i for i in set(plan) if i[0] == loan), key=lambda i: (i[2], i[1])
            ):
                paid = min(due, max(total - before, Decimal(0)))
                end, run, settled = before + due, Decimal(0), None
                for p in live:
                    if run < end <= run + p[4]:
                        settled = p[3]
                    run += p[4]
                left = due - paid
                late = (cutoff - due_date).days if due_date < cutoff and left > 0 else 0
                out.append((cutoff, loan, number, due_date, due, paid, left, settled, late))
                before = end
    return out


def random_case(seed):
    rng = random.Random(seed)
    loans = [(n, date(2023, 10, 1) + timedelta(days=rng.randrange(300))) for n in range(1, 9)]
    plan, payments = [], []
    for loan, start in loans + [(99, date(2024, 1, 1))]:
        for n in range(1, rng.randrange(2, 7)):
            plan.append((loan, n, start + timedelta(days=30 * n), Decimal(rng.randrange(0, 9))))
        for _ in range(rng.randrange(0, 12)):
            day = datetime(2023, 11, 1) + timedelta(days=rng.randrange(240))
            at = day + timedelta(hours=rng.choice([1, 4, 6, 12, 12, 23]))
            back = at + timedelta(days=rng.randrange(0, 90)) if rng.random() < 0.4 else None
            payments.append((rng.choice(["a", "b"]), len(payments), loan, at, Decimal(rng.randrange(0, 7)), back))
            if rng.random() < 0.3:
                payments.append(("a", len(payments), loan, at + timedelta(hours=rng.choice([0, 0, 1])), Decimal(2), None))
    plan += plan[:3]
    return loans, plan, payments


def frames(spark, case):
    loans, plan, payments = case
    return (
        spark.createDataFrame(loans, "loan_id long, disbursement_date date"),
        spark.createDataFrame(
            plan, "loan_id long, installment_number int, due_date date, amount_due decimal(18,2)"
        ),
        spark.createDataFrame(
            payments,
            "source_system string, payment_id long, loan_id long, paid_at_utc timestamp_ntz, "
            "amount decimal(18,2), reversed_at_utc timestamp_ntz",
        ),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_allocation_matches_definition(planned, seed):
    case = random_case(seed)
    expected = expected_status(*case)
    assert any(r[7] for r in expected) and any(r[8] for r in expected)
    got = allocate(*frames(planned, case), CUTOFF)
    assert rows(got) == sorted(expected, key=str)
    final = allocate(*frames(planned, case), CUTOFF, final_only=True)
    assert rows(final) == sorted((r for r in expected if r[0] == CUTOFF), key=str)
    plain = allocate(*frames(planned, case), CUTOFF, with_settlement=False)
    same = [c for c in plain.columns if c != "settlement_at_utc"]
    assert table_diff(plain.select(same), got.select(same)).isEmpty()
    summed = defaultdict(lambda: (Decimal(0), 0))
    for r in expected:
        balance, late = summed[r[0], r[1]]
        summed[r[0], r[1]] = (balance + r[6], max(late, r[8]))
    balances = balances_by_month_end(*frames(planned, case), CUTOFF)
    assert rows(balances) == sorted(((*k, *v) for k, v in summed.items()), key=str)


def test_months_are_spread_as_integers(spark):
    """Dates a month apart are slow to make: each goes through the session's time zone."""
    status = allocate(*frames(spark, random_case(1)), CUTOFF, with_settlement=False)
    plan = status._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "sequence(" in plan and "interval" not in plan


def test_many_instants_on_one_day(planned):
    """A loan paid in small parts within one day; the part that reaches an end settles it."""
    loans = [(1, date(2024, 3, 1))]
    plan = [(1, n, date(2024, 3, 1) + timedelta(days=30 * n), Decimal(50)) for n in (1, 2, 3)]
    start = datetime(2024, 4, 2, 6)
    payments = [
        ("a", n, 1, start + timedelta(minutes=n // 2), Decimal(1), None) for n in range(120)
    ]
    case = (loans, plan, payments)
    got = allocate(*frames(planned, case), CUTOFF)
    assert rows(got) == sorted(expected_status(*case), key=str)


def test_allocation_edges(spark):
    loans = [(1, date(2024, 3, 1)), (2, date(2024, 3, 1)), (3, date(2024, 3, 1))]
    plan = [(1, n, date(2024, 3, 1) + timedelta(days=30 * n), Decimal(10)) for n in (1, 2, 3)]
    plan += [(2, 1, date(2024, 4, 1), Decimal(10)), (3, 1, date(2024, 7, 15), Decimal(10))]
    payments = [
        # One payment over three installments with a surplus.
        ("a", 1, 1, datetime(2024, 4, 2, 12), Decimal(31), None),
        # Paid in April, reversed in May: open again from May on.
        ("a", 2, 2, datetime(2024, 4, 10, 12), Decimal(10), datetime(2024, 5, 3, 12)),
    ]
    got = final_status(allocate(*frames(spark, (loans, plan, payments)), CUTOFF), CUTOFF)
    state = {(r.loan_id, r.installment_number): r for r in got.collect()}
    assert all(state[1, n].remaining_amount == 0 for n in (1, 2, 3))
    assert state[1, 3].settlement_date == date(2024, 4, 2)
    assert (state[2, 1].remaining_amount, state[2, 1].days_past_due) == (10, 90)
    assert state[2, 1].settlement_at_utc is None
    assert state[3, 1].days_past_due == 0
    april = allocate(*frames(spark, (loans, plan, payments)), date(2024, 4, 30))
    kept = april.where("loan_id = 2 and cutoff_date = date'2024-04-30'").first()
    assert kept.remaining_amount == 0 and kept.settlement_at_utc == datetime(2024, 4, 10, 12)


def test_reversal_in_same_month_never_counts(spark):
    payments = [
        ("a", 1, 1, datetime(2024, 4, 2, 12), Decimal(5), datetime(2024, 4, 20, 12)),
        # Local date is still April 30, so it counts at the April month-end.
        ("a", 2, 1, datetime(2024, 5, 1, 4), Decimal(5), datetime(2024, 6, 1, 6)),
    ]
    df = frames(spark, ([(1, date(2024, 1, 1))], [(1, 1, date(2024, 2, 1), Decimal(1))], payments))[2]
    got = effective_by_month_end(df, CUTOFF).select("payment_id", "cutoff_date")
    assert rows(got) == [(2, date(2024, 4, 30)), (2, date(2024, 5, 31))]


def test_received_totals_spread_months_last(planned):
    """Totals equal the sums of payments by month-end, and no sum follows the months."""
    made = random.Random(5)
    payments = []
    for n in range(120):
        paid = datetime(2024, made.randint(1, 6), made.randint(1, 28), 12)
        back = paid + timedelta(days=made.randint(1, 90)) if n % 3 == 0 else None
        loan = None if n % 20 == 0 else made.randint(1, 9)
        amount = None if n % 11 == 0 or loan == 9 else Decimal(made.randint(0, 999)) / 100
        payments.append(("a", n, loan, paid, amount, back))
    df = planned.createDataFrame(
        payments,
        "source_system string, payment_id long, loan_id long, paid_at_utc timestamp_ntz, "
        "amount decimal(18,2), reversed_at_utc timestamp_ntz",
    )
    expected = (
        effective_by_month_end(df, CUTOFF)
        .groupBy("loan_id", "cutoff_date")
        .agg(F.sum("amount").alias("amount"))
    )
    got = received_by_month_end(df, CUTOFF)
    assert rows(got) == rows(expected)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_pieces_follow_the_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert pieces_for(spark, 0) == least
    assert pieces_for(spark, 300_000 * 1000 + 1) == 1001


def test_payments_meet_copies_and_reversals_in_one_shuffle(spark):
    made = [
        ("1", "7", "2024-03-01 10:00:00", "5.00", "core_v2", "CARD", "SETTLED", None),
        ("1", "7", "2024-03-01T10:00:00Z", "5.00", "core_v2", "CARD", "SETTLED", None),
        ("2", "7", "2024-03-02 10:00:00", "6.00", "core_v2", "CARD", "SETTLED", None),
        ("9", "7", "2024-04-02 10:00:00", "6.00", "core_v2", "CARD", "REVERSED", "2"),
    ]
    raw = spark.createDataFrame(
        made,
        "payment_id string, loan_ref string, paid_at_utc string, amount_raw string, "
        "source_system string, payment_method string, status string, reversed_payment_id string",
    )
    history = int_payment_history(raw, 11)
    assert rows(history.select("payment_id", "reversed_at_utc")) == [
        (1, None),
        (2, datetime(2024, 4, 2, 10)),
    ]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = exchanges(int_payment_history(raw, 11))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Copies are equal in all columns; none is dealt by the others.
    assert found and not any("payment_method" in line.split("ENSURE")[0] for line in found)
    assert any(", 11)" in line for line in found)


def test_ledger_in_pieces_is_the_ledger(planned):
    """Copies of the plan and days of several instants, with and without pieces."""
    loans = planned.createDataFrame(
        [(1, date(2024, 1, 5)), (2, date(2024, 2, 5))], "loan_id long, disbursement_date date"
    )
    plan = planned.createDataFrame(
        [(n, i, date(2024, 1 + i, 1), Decimal(10)) for n in (1, 2, 3) for i in (1, 2, 2)],
        "loan_id long, installment_number int, due_date date, amount_due decimal(18,2)",
    )
    payments = planned.createDataFrame(
        [(n, datetime(2024, 3, 1 + h % 2, 12 + h), Decimal(3), None) for n in (1, 2, 3) for h in (0, 1, 2)],
        "loan_id long, paid_at_utc timestamp_ntz, amount decimal(18,2), reversed_at_utc timestamp_ntz",
    )
    plain = ledger(loans, plan, payments, CUTOFF)
    dealt = ledger(loans, plan, payments, CUTOFF, pieces=11)
    for table in ("plan", "days", "instants"):
        assert rows(getattr(dealt, table)) == rows(getattr(plain, table))
    assert len(rows(dealt.plan)) == 4 and len(rows(dealt.instants)) == 4
    # Few days of several instants are sent to the payments.
    assert "BroadcastHashJoin" in dealt.instants._jdf.queryExecution().executedPlan().toString()
    again = ledger(loans, plan, payments, CUTOFF, plan=plain.plan)
    assert again.plan is plain.plan


def small_ledger(spark, store=lambda df, name: df):
    """Two loans, the second with a reversal and payments of one day at several instants."""
    loans = spark.createDataFrame(
        [(1, date(2024, 1, 5)), (2, date(2024, 2, 9)), (3, None)],
        "loan_id long, disbursement_date date",
    )
    plan = spark.createDataFrame(
        [
            (loan, n, date(2024, n + 1, 10) if n < 4 else None, Decimal("10.50"))
            for loan in (1, 2)
            for n in (1, 2, 3, 4)
        ],
        "loan_id long, installment_number int, due_date date, amount_due decimal(18,2)",
    )
    paid = [
        (1, datetime(2024, 3, 1, 12), Decimal("15.00"), None),
        (2, datetime(2024, 3, 2, 12), Decimal("10.50"), datetime(2024, 5, 3, 12)),
        (2, datetime(2024, 3, 2, 13), Decimal("10.50"), None),
        (2, datetime(2024, 4, 2, 13), Decimal("3.00"), None),
    ]
    payments = spark.createDataFrame(
        paid,
        "loan_id long, paid_at_utc timestamp_ntz, amount decimal(18,2),"
        " reversed_at_utc timestamp_ntz",
    )
    return ledger(store(loans, "loans"), plan, payments, CUTOFF, bucketed=store)


def test_status_is_shown_by_the_step(planned):
    """The plain form of a step is made once and copied to its months, not made by the month."""
    book = small_ledger(planned)
    shown = allocation_of(book, shown=present)
    assert shown.columns == allocation_of(book).columns
    got = rows(shown)
    assert len(got) == 4 * (6 + 5)
    assert got == rows(present(allocation_of(book)))
    assert {r[7] for r in got} == {
        None, "2024-03-01 12:00:00.000", "2024-03-02 12:00:00.000", "2024-03-02 13:00:00.000"
    }


def test_the_query_shows_steps(spark):
    plan = all_queries()["int_installment_status"](spark, FOLDER)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    # Children stand below their parents.
    assert text.index("Generate explode") < text.index("date_format(")


def test_settlements_meet_in_the_buckets_of_loans(spark):
    """No more than the loan's id deals out, also if joins ask for all their keys."""
    layers = Layers(spark)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.requireAllClusterKeysForCoPartition": "true",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, value in conf.items():
        spark.conf.set(k, value)
    try:
        book = small_ledger(
            spark, lambda df, name: layers.write_bucketed(df, "silver", name, "loan_id", 3)
        )
        status = allocation_of(book)
        plan = status._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert not [line for line in dealt if "installment_number" in line]
        assert rows(status) == rows(allocation_of(small_ledger(spark)))
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)
        layers.close()
