"""First-in-first-out allocation of payments to installments at month-ends.

Two cumulative scales are compared per loan: what is due up to each installment
and what has been paid. How much was paid changes only in months where a payment
arrives or is reversed, so balances are held as *steps* (spans of month-ends with
one total) and expanded to one row per month-end at the very end.

A reversal changes which payment completed an installment, an arrival does not.
So settlement is worked out once per *epoch*, a span of month-ends between two
reversals of the loan. Loans without reversals, nearly all of them, have one.

Hot loans: payments are summed per loan and day (or month) before any window, so
a window never holds more than one loan's calendar, whatever its payment count.
Amounts must not be negative, which the quality checks verify.

Everything starts from a *ledger*: plan and paid days of the valid loans. Stored in
buckets by loan, all that follows per loan (windows, sums, joins) runs where the rows
lie, and payments are read and summed once for all consumers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.instants import (
    local_date,
    month_end,
    month_end_text,
    month_numbers,
    month_start,
    month_starts,
)

ALWAYS = "date'0001-01-01'"
NEVER = "date'9999-12-31'"


def due_ranges(installments: DataFrame) -> DataFrame:
    """Add the cumulative due range ``(due_before, due_end]`` of each installment.

    The window holds one loan's payment plan.
    """
    order = Window.partitionBy("loan_id").orderBy(
        F.col("due_date").asc_nulls_last(), F.col("installment_number").asc_nulls_last()
    )
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("amount_due").over(earlier), F.lit(0))
    return installments.withColumn(
        "due_before", before.cast("decimal(28,2)")
    ).withColumn("due_end", (F.col("due_before") + F.col("amount_due")).cast("decimal(28,2)"))


def month_ends_between(first: Column, cutoff: date) -> Column:
    """Array of month-ends from the month of ``first`` through the cutoff."""
    starts = month_starts(first, F.lit(cutoff))
    return F.when(first <= F.lit(cutoff), F.transform(starts, F.last_day))


def effective_span(payments: DataFrame, cutoff: date) -> DataFrame:
    """Keep payments that count at some month-end; add the span in which they do.

    A payment counts at month-ends from ``counts_from`` on, before
    ``counts_until`` (null: still counting at the cutoff). One that is reversed in
    the month it arrived never counts and is dropped.
    """
    arrived = F.last_day(local_date(F.col("paid_at_utc")))
    reversed_in = F.last_day(local_date(F.col("reversed_at_utc")))
    spans = payments.withColumns(
        {
            "paid_date": local_date(F.col("paid_at_utc")),
            "counts_from": arrived,
            "counts_until": F.when(reversed_in <= F.lit(cutoff), reversed_in),
        }
    )
    return spans.where(
        (F.col("counts_from") <= F.lit(cutoff))
        & (F.col("counts_until").isNull() | (F.col("counts_until") > F.col("counts_from")))
    )


def effective_at(payments: DataFrame, cutoff: date) -> DataFrame:
    """Payments that count at one month-end; ``counts_until`` is null for all."""
    spans = effective_span(payments, cutoff)
    return spans.where(F.col("counts_until").isNull())


def _each_month_end(spans: DataFrame, cutoff: date) -> DataFrame:
    """Repeat each span for the month-ends in it, as ``cutoff_date``."""
    last = F.coalesce(F.date_sub(month_start(F.col("counts_until")), 1), F.lit(cutoff))
    months = month_numbers(F.col("counts_from"), last)
    return (
        spans.withColumn("_month", F.explode(months))
        .withColumn("cutoff_date", month_end(F.col("_month")))
        .drop("_month")
    )


def effective_by_month_end(payments: DataFrame, cutoff: date) -> DataFrame:
    """One row per payment and month-end at which it counts, without a join."""
    return _each_month_end(effective_span(payments, cutoff), cutoff)


def received_by_month_end(payments: DataFrame, cutoff: date) -> DataFrame:
    """Effective payment total per loan and month-end.

    Months are spread last: a total holds from one change to the next.
    """
    return _received(effective_span(payments, cutoff), cutoff)


def _received(spans: DataFrame, cutoff: date) -> DataFrame:
    return month_ends_of_step(received_steps(spans, cutoff)).select(
        "loan_id", "cutoff_date", "amount"
    )


def received_steps(spans: DataFrame, cutoff: date) -> DataFrame:
    """Effective total per loan as steps ``[step_from, step_to)`` in which payments count.

    Changes are summed per loan and month before the window, which holds a calendar. The
    amount is null while none of the payments that count has one.
    """
    amount = F.col("amount").cast("decimal(28,2)")

    def change(month: str, sign: int) -> Column:
        signed = amount if sign > 0 else (-amount).cast("decimal(28,2)")
        return F.struct(
            F.col(month).alias("month"), signed.alias("amount"), F.lit(sign).alias("n")
        )

    arrival, end = change("counts_from", 1), change("counts_until", -1)
    monthly = (
        spans.select(
            "loan_id",
            F.inline(
                F.when(F.col("counts_until").isNull(), F.array(arrival)).otherwise(
                    F.array(arrival, end)
                )
            ),
        )
        .groupBy("loan_id", "month")
        .agg(
            F.sum("amount").alias("change"),
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("amount").isNotNull(), F.col("n"))).alias("known"),
        )
    )
    order = Window.partitionBy("loan_id").orderBy("month")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("change").over(so_far).cast("decimal(38,2)")
    return monthly.select(
        "loan_id",
        F.col("month").alias("step_from"),
        F.coalesce(F.lead("month").over(order), F.date_add(F.lit(cutoff), 1)).alias("step_to"),
        F.when(F.sum("known").over(so_far) > 0, total).alias("amount"),
        F.sum("n").over(so_far).alias("_open"),
    ).where("_open > 0").drop("_open")


def paid_days(spans: DataFrame, loan_ids: DataFrame) -> DataFrame:
    """Payments summed per loan, day and span, for the given loans.

    ``first_at`` and ``last_at`` bound the instants merged into a day. The sums come
    before the loans, so a hot loan is at most its calendar by then.
    """
    return (
        spans.groupBy("loan_id", "paid_date", "counts_until")
        .agg(
            F.sum("amount").cast("decimal(28,2)").alias("amount"),
            F.min("paid_at_utc").alias("first_at"),
            F.max("paid_at_utc").alias("last_at"),
        )
        .join(loan_ids, "loan_id", "left_semi")
        .select(
            "loan_id",
            "paid_date",
            F.last_day("paid_date").alias("counts_from"),
            "counts_until",
            "amount",
            "first_at",
            "last_at",
        )
    )


#: Days of several instants that tasks may receive, some 16 MB; more are joined by a shuffle.
MOST_DAYS = 500_000


def paid_instants(spans: DataFrame, days: DataFrame, counted: bool = False) -> DataFrame:
    """Payments summed per instant and span, for days whose payments differ in instant.

    ``counted`` counts these days first: few are sent to the payments, which then stay
    where they are.
    """
    mixed = (
        days.groupBy("loan_id", "paid_date")
        .agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
        .where("first_at < last_at")
        .select("loan_id", "paid_date")
    )
    if counted and mixed.count() <= MOST_DAYS:
        mixed = F.broadcast(mixed)
    return (
        spans.select("loan_id", "paid_date", "paid_at_utc", "counts_until", "amount")
        .join(mixed, ["loan_id", "paid_date"], "left_semi")
        .groupBy("loan_id", "paid_date", "counts_until", "paid_at_utc")
        .agg(F.sum("amount").cast("decimal(28,2)").alias("amount"))
    )


@dataclass(frozen=True)
class Ledger:
    """What allocation needs of the valid loans, each table ready to meet the others.

    ``loans``: loan_id, disbursement_date. ``plan``: installments with their due range.
    ``days``: see ``paid_days``. ``instants``: see ``paid_instants``.
    """

    loans: DataFrame
    plan: DataFrame
    days: DataFrame
    instants: DataFrame
    cutoff: date

    def of(self, installments: Column) -> Ledger:
        """The ledger with some installments only; their due ranges stay."""
        return Ledger(
            self.loans, self.plan.where(installments), self.days, self.instants, self.cutoff
        )


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def ledger(
    loans: DataFrame,
    installments: DataFrame,
    payments: DataFrame,
    cutoff: date,
    bucketed: Callable[[DataFrame, str], DataFrame] = _as_is,
    stored: Callable[[DataFrame, str], DataFrame] = _as_is,
    plan: DataFrame | None = None,
    pieces: int | None = None,
) -> Ledger:
    """The ledger through a cutoff; the callables may store its tables.

    ``loans`` needs loan_id and disbursement_date, ``installments`` the typed
    plan, ``payments`` the settled history with reversal instants. Plan and days hold no
    more than a plan and a calendar of one loan, so buckets by loan suit them; instants
    of a hot loan may be many and are left as they come. The plan is the same at every
    cutoff; ``plan`` gives the one of an earlier ledger. ``pieces`` is how many buckets the
    stored loans have: the plan's copies are dropped in the bucket that they go to, and days
    of several instants are counted, which needs stored tables.
    """
    ids = loans.select("loan_id")
    if plan is None:
        dealt = installments.repartition(pieces, "loan_id") if pieces else installments
        due = dealt.distinct().join(ids, "loan_id", "left_semi")
        plan = bucketed(due_ranges(due), "due_ranges")
    known = payments.select("loan_id", "paid_at_utc", "amount", "reversed_at_utc")
    spans = effective_span(known, cutoff)
    days = bucketed(paid_days(spans, ids), "paid_days")
    return Ledger(
        loans.select("loan_id", "disbursement_date"),
        plan,
        days,
        stored(paid_instants(spans, days, counted=bool(pieces)), "paid_instants"),
        cutoff,
    )


def received_of(book: Ledger) -> DataFrame:
    """Effective payment total per valid loan and month-end."""
    return _received(book.days, book.cutoff)


def received_steps_of(book: Ledger) -> DataFrame:
    """Effective payment total per valid loan and step."""
    return received_steps(book.days, book.cutoff)


def total_steps(days: DataFrame) -> DataFrame:
    """Total paid per loan as steps ``[step_from, step_to)`` over month-ends.

    Begins with a zero step before the first arrival. ``epoch_from`` is the
    loan's latest reversal month up to the step.
    """
    arrival = F.struct(
        F.col("counts_from").alias("month"), F.col("amount"), F.lit(False).alias("gone")
    )
    reversal = F.struct(
        F.col("counts_until").alias("month"),
        (-F.col("amount")).cast("decimal(28,2)").alias("amount"),
        F.lit(True).alias("gone"),
    )
    changes = days.select(
        "loan_id",
        F.inline(
            F.when(F.col("counts_until").isNull(), F.array(arrival)).otherwise(
                F.array(arrival, reversal)
            )
        ),
    )
    monthly = changes.groupBy("loan_id", "month").agg(
        F.sum("amount").alias("change"), F.bool_or("gone").alias("gone")
    )
    order = Window.partitionBy("loan_id").orderBy("month")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    epoch = F.max(F.when(F.col("gone"), F.col("month"))).over(so_far)
    running = monthly.select(
        "loan_id",
        "month",
        F.sum("change").over(so_far).cast("decimal(28,2)").alias("total_paid"),
        F.coalesce(epoch, F.expr(ALWAYS)).alias("epoch_from"),
        F.coalesce(F.lead("month").over(order), F.expr(NEVER)).alias("step_to"),
        (F.row_number().over(order) == 1).alias("first"),
    )
    step = F.struct(
        F.col("month").alias("step_from"), "step_to", "total_paid", "epoch_from"
    )
    nothing_yet = F.struct(
        F.expr(ALWAYS).alias("step_from"),
        F.col("month").alias("step_to"),
        F.lit(0).cast("decimal(28,2)").alias("total_paid"),
        F.expr(ALWAYS).alias("epoch_from"),
    )
    return running.select(
        "loan_id",
        F.inline(F.when(F.col("first"), F.array(nothing_yet, step)).otherwise(F.array(step))),
    )


def _per_epoch(daily: DataFrame) -> DataFrame:
    """Repeat each day's payments for the epochs of the loan in which they count."""
    # At most one entry per calendar month, so the set is bounded.
    reversals = F.array_sort(
        F.collect_set("counts_until").over(Window.partitionBy("loan_id"))
    )
    starts = F.concat(F.array(F.expr(ALWAYS)), reversals)
    ends = F.concat(reversals, F.array(F.expr(NEVER)))
    return (
        daily.withColumn("_starts", starts)
        .withColumn("_ends", ends)
        .select(
            "*",
            F.explode(F.arrays_zip("_starts", "_ends")).alias("_epoch"),
        )
        .withColumn("epoch_from", F.col("_epoch._starts"))
        .where(
            (F.col("counts_from") < F.col("_epoch._ends"))
            & (
                F.col("counts_until").isNull()
                | (F.col("counts_until") > F.col("epoch_from"))
            )
        )
        .groupBy("loan_id", "epoch_from", "paid_date", "counts_from")
        .agg(
            F.sum("amount").alias("amount"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    )


def daily_ranges(days: DataFrame, one_epoch: bool = False) -> DataFrame:
    """Running paid ranges ``(paid_before, paid_after]`` per loan, epoch and day.

    ``one_epoch`` says that no span ends, as at a single month-end.
    """
    if one_epoch:
        in_epoch = days.withColumn("epoch_from", F.expr(ALWAYS))
    else:
        in_epoch = _per_epoch(days)
    so_far = (
        Window.partitionBy("loan_id", "epoch_from")
        .orderBy("paid_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    after = F.sum("amount").over(so_far).cast("decimal(28,2)")
    return in_epoch.withColumn("paid_after", after).withColumn(
        "paid_before", (F.col("paid_after") - F.col("amount")).cast("decimal(28,2)")
    )


def completed_at(
    due: DataFrame, book: Ledger, one_epoch: bool = False, how: str = "inner"
) -> DataFrame:
    """Add when each installment was completed, once per epoch of its loan.

    ``due`` has loan_id, due_end and any other columns of installments in the ledger's
    plan. Finds the day whose paid range covers the installment's end. If
    payments of different instants share that day, the instant is looked up among
    the day's instants; only such days have any. Adds epoch_from,
    counts_from and settlement_at_utc; ``how="left"`` keeps installments that were
    never completed. With ``one_epoch`` only what still counts at the cutoff does.
    """
    paid = book.days.where("counts_until is null") if one_epoch else book.days
    days = daily_ranges(paid, one_epoch)
    covers = (
        (F.col("loan_id") == F.col("_day_loan"))
        & (F.col("paid_before") < F.col("due_end"))
        & (F.col("paid_after") >= F.col("due_end"))
    )
    crossed = due.join(days.withColumnRenamed("loan_id", "_day_loan"), covers, how)
    day_key = ["loan_id", "epoch_from", "paid_date"]
    ends = book.plan.select(F.col("loan_id").alias("_day_loan"), "due_end")
    mixed = (
        days.where("first_at < last_at")
        .join(ends, covers, "left_semi")
        .select(*day_key, "paid_before")
    )
    so_far = (
        Window.partitionBy(*day_key)
        .orderBy("paid_at_utc")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    counting = "counts_until is null"
    if not one_epoch:
        counting += " or counts_until > epoch_from"
    instants = (
        book.instants.join(mixed, ["loan_id", "paid_date"])
        .where(counting)
        .groupBy(*day_key, "paid_before", "paid_at_utc")
        .agg(F.sum("amount").alias("amount"))
        .withColumn("upto", F.col("paid_before") + F.sum("amount").over(so_far))
        .select(
            *[F.col(c).alias(f"_i_{c}") for c in day_key],
            F.col("paid_at_utc").alias("instant"),
            (F.col("upto") - F.col("amount")).alias("over"),
            "upto",
        )
    )
    found = (
        (F.col("first_at") < F.col("last_at"))
        & (F.col("over") < F.col("due_end"))
        & (F.col("upto") >= F.col("due_end"))
    )
    same_day = [F.col(c) == F.col(f"_i_{c}") for c in day_key]
    return crossed.join(instants, [*same_day, found], "left").select(
        *due.columns,
        "epoch_from",
        "counts_from",
        F.coalesce("instant", "first_at").alias("settlement_at_utc"),
    )


def steps_of_loans(
    loans: DataFrame, steps: DataFrame, first: Column, cutoff: date
) -> DataFrame:
    """Each loan's steps from ``first`` through the cutoff; one of zero without payments."""
    start = F.greatest(F.coalesce("step_from", F.expr(ALWAYS)), first)
    stop = F.least(F.coalesce("step_to", F.expr(NEVER)), F.date_add(F.lit(cutoff), 1))
    return (
        loans.select("loan_id", "disbursement_date")
        .where(F.col("disbursement_date") <= F.lit(cutoff))
        .join(steps, "loan_id", "left")
        .select(
            "loan_id",
            start.alias("step_from"),
            stop.alias("step_to"),
            F.coalesce("total_paid", F.lit(0)).cast("decimal(28,2)").alias("total_paid"),
            F.coalesce("epoch_from", F.expr(ALWAYS)).alias("epoch_from"),
        )
        .where("step_from < step_to")
    )


def paid_part() -> Column:
    """What of an installment the loan's total covers."""
    covered = F.greatest(F.col("total_paid") - F.col("due_before"), F.lit(0))
    return F.least(F.col("amount_due"), covered).cast("decimal(18,2)")


def month_ends_of_step(rows: DataFrame) -> DataFrame:
    """Repeat rows for the month-ends of their step, as ``cutoff_date``."""
    # Both a month-end bound and the day after the cutoff are exclusive.
    last = F.date_sub(month_start(F.col("step_to")), 1)
    return rows.withColumn(
        "_month", F.explode(month_numbers(F.col("step_from"), last))
    ).withColumn("cutoff_date", month_end(F.col("_month")))


def balances_of(book: Ledger) -> DataFrame:
    """Unpaid balance and days past due (``dpd``) per loan and month-end.

    A balance holds for a whole step, and the days past due count from the first due
    date still open. So installments are summed per step, and only then are months
    spread: no row per month and installment ever exists.
    """
    steps = total_steps(book.days)
    remaining = (F.col("amount_due") - paid_part()).cast("decimal(18,2)")
    per_step = (
        steps_of_loans(book.loans, steps, F.last_day("disbursement_date"), book.cutoff)
        .join(book.plan, "loan_id")
        .withColumn("remaining", remaining)
        .groupBy("loan_id", "step_from", "step_to")
        .agg(
            F.sum("remaining").alias("balance_local"),
            F.min(F.when(F.col("remaining") > 0, F.col("due_date"))).alias("open_since"),
        )
    )
    late = F.datediff("cutoff_date", "open_since")
    return month_ends_of_step(per_step).select(
        "cutoff_date",
        "loan_id",
        "balance_local",
        F.greatest(F.coalesce(late, F.lit(0)), F.lit(0)).alias("dpd"),
    )


def balances_by_month_end(
    loans: DataFrame, installments: DataFrame, payments: DataFrame, cutoff: date
) -> DataFrame:
    """``balances_of`` these tables."""
    return balances_of(ledger(loans, installments, payments, cutoff))


def allocate(
    loans: DataFrame,
    installments: DataFrame,
    payments: DataFrame,
    cutoff: date,
    final_only: bool = False,
    with_settlement: bool = True,
) -> DataFrame:
    """``allocation_of`` the ledger of these tables."""
    book = ledger(loans, installments, payments, cutoff)
    return allocation_of(book, final_only, with_settlement)


#: Gives columns of rows another form, but for the named ones.
Shown = Callable[[DataFrame, Sequence[str]], DataFrame]


def allocation_of(
    book: Ledger,
    final_only: bool = False,
    with_settlement: bool = True,
    shown: Shown | None = None,
) -> DataFrame:
    """Installment status per month-end, loan and installment.

    With ``final_only`` just the cutoff is produced and no calendar is expanded. ``shown``
    is for the month-ends of all steps: it gives the columns their form while a row is a
    step, so that the many rows of its months copy it; their month-ends are text.
    """
    cutoff = book.cutoff
    open_since = F.when(F.col("remaining_amount") > 0, F.col("due_date"))
    status = _status_by_step(book, final_only, with_settlement).withColumn(
        "_open_since", open_since
    )
    month = F.col("cutoff_date")
    if final_only:
        dated = status.withColumn("cutoff_date", F.lit(cutoff))
    elif shown:
        kept = ["step_from", "step_to", "_open_since"]
        dated = month_ends_of_step(shown(status, kept))
        month = month_end_text(F.col("_month")).alias("cutoff_date")
    else:
        dated = month_ends_of_step(status)
    late = F.datediff("cutoff_date", "_open_since")
    return dated.select(
        month,
        "loan_id",
        "installment_number",
        "due_date",
        "amount_due",
        "paid_amount",
        "remaining_amount",
        "settlement_at_utc",
        F.greatest(F.coalesce(late, F.lit(0)), F.lit(0)).alias("days_past_due"),
    )


def amounts_by_step(book: Ledger) -> DataFrame:
    """What is paid and open of each installment, per step ``[step_from, step_to)``.

    Steps of one loan are equal or apart, also if its id has several disbursements.
    """
    status = _status_by_step(book, with_settlement=False, common_steps=True)
    return status.drop("settlement_at_utc")


def _at_common_bounds(steps: DataFrame) -> DataFrame:
    """Steps cut where another step of the loan begins.

    The set holds at most the loan's calendar.
    """
    starts = F.array_sort(F.collect_set("step_from").over(Window.partitionBy("loan_id")))
    cuts = F.filter(
        "_starts", lambda day: (day > F.col("step_from")) & (day < F.col("step_to"))
    )
    parts = F.arrays_zip(
        F.concat(F.array("step_from"), "_cuts").alias("begin"),
        F.concat("_cuts", F.array("step_to")).alias("end"),
    )
    rest = [c for c in steps.columns if c not in ("step_from", "step_to")]
    return (
        steps.withColumn("_starts", starts)
        .withColumn("_cuts", cuts)
        .select(*rest, F.explode(parts).alias("_part"))
        .select(
            *rest, F.col("_part.begin").alias("step_from"), F.col("_part.end").alias("step_to")
        )
    )


def _equal(left: str, right: str) -> Column:
    """Equality that is no join key: by a loan's id alone rows meet in its bucket.

    With more keys Spark deals both sides out anew. All pairs of rows of one loan are
    compared, so a loan must have a plan's and a calendar's rows on either side, not more.
    """
    return (F.col(left) <= F.col(right)) & (F.col(left) >= F.col(right))


def _status_by_step(
    book: Ledger,
    final_only: bool = False,
    with_settlement: bool = True,
    common_steps: bool = False,
) -> DataFrame:
    """Status that holds for a whole step; only days past due differ in its months."""
    cutoff = book.cutoff
    if final_only:
        counting = book.days.where("counts_until is null")
        steps = counting.groupBy("loan_id").agg(
            F.sum("amount").cast("decimal(28,2)").alias("total_paid")
        ).select(
            "loan_id",
            "total_paid",
            F.lit(cutoff).alias("step_from"),
            F.expr(NEVER).alias("step_to"),
            F.expr(ALWAYS).alias("epoch_from"),
        )
    else:
        steps = total_steps(book.days)
    first = F.lit(cutoff) if final_only else F.last_day("disbursement_date")
    spread = steps_of_loans(book.loans, steps, first, cutoff)
    if common_steps:
        spread = _at_common_bounds(spread)
    status = spread.join(book.plan, "loan_id").withColumn("paid_amount", paid_part())
    if not with_settlement:
        status = status.withColumn("settlement_at_utc", F.lit(None).cast("timestamp_ntz"))
    elif final_only:
        # One step and one epoch per loan: look up from the status rows themselves.
        status = completed_at(status.drop("epoch_from"), book, one_epoch=True, how="left")
    else:
        due = book.plan.select("loan_id", "installment_number", "due_end")
        done = completed_at(due, book).select(
            F.col("loan_id").alias("_done_loan"),
            F.col("epoch_from").alias("_done_epoch"),
            F.col("installment_number").alias("_done_number"),
            "counts_from",
            "settlement_at_utc",
        )
        same = (
            (F.col("loan_id") == F.col("_done_loan"))
            & _equal("epoch_from", "_done_epoch")
            & _equal("installment_number", "_done_number")
        )
        visible = F.col("counts_from") <= F.col("step_from")
        status = status.join(done, same, "left").withColumn(
            "settlement_at_utc", F.when(visible, F.col("settlement_at_utc"))
        )
    remaining = (F.col("amount_due") - F.col("paid_amount")).cast("decimal(18,2)")
    return status.select(
        "loan_id",
        "step_from",
        "step_to",
        "installment_number",
        "due_date",
        "amount_due",
        "paid_amount",
        remaining.alias("remaining_amount"),
        "settlement_at_utc",
    )


def month_end_calendar(loans: DataFrame, cutoff: date) -> DataFrame:
    """Every month-end from the first disbursement through the cutoff."""
    first = loans.agg(F.min("disbursement_date").alias("first"))
    return first.select(
        F.explode(month_ends_between(F.col("first"), cutoff)).alias("cutoff_date")
    )
