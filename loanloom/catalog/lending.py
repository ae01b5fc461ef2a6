"""Registered queries: the lending tables and answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanloom.plans import answers
from loanloom.plans.lending import Lending
from loanloom.samples.lending import COHORT, CUTOFF, RawTables
from loanloom.sources.layers import Layers

Query = Callable[[SparkSession, str], DataFrame]


# The loaded extracts of each session and folder, and the tables stored from them.
# Queries share both as those of one build share its silver layer.
_BRONZE: dict[tuple[str, str], RawTables] = {}
_LENDING: dict[tuple[str, str], Lending] = {}


_OPENED: list[Layers] = []


def opened(spark: SparkSession) -> Layers:
    """A folder for queries' tables, until ``release``."""
    _OPENED.append(Layers(spark))
    return _OPENED[-1]


def release() -> None:
    """Removes the tables that queries stored so far; their results must be read by then."""
    _LENDING.clear()
    while _OPENED:
        _OPENED.pop().close()


def extracts(spark: SparkSession, folder: str) -> RawTables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BRONZE:
        _BRONZE[key] = RawTables(spark, folder, Layers(spark))
    return _BRONZE[key]


def lending(spark: SparkSession, folder: str) -> Lending:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LENDING:
        _LENDING[key] = Lending(extracts(spark, folder), CUTOFF, opened(spark))
    return _LENDING[key]


def _table(name: str) -> Query:
    return lambda spark, folder: getattr(lending(spark, folder), name)


def _q4(spark: SparkSession, folder: str) -> DataFrame:
    tables = lending(spark, folder)
    return answers.fpd30(
        tables.fct_installment_status, tables.stored_loan, CUTOFF, COHORT
    )


LENDING: dict[str, Query] = {
    **{
        name: _table(name)
        for name in (
            "dim_customer",
            "dim_merchant",
            "fct_application",
            "fct_loan",
            "int_payment_history",
            "fct_payment",
            "int_installment_status",
            "fct_installment_status",
            "dm_loan_delinquency_snapshot",
            "agg_merchant_monthly",
        )
    },
    "q1_applications_approval": lambda s, d: answers.applications_approval(
        lending(s, d).fct_application
    ),
    "q2_loans_gmv": lambda s, d: answers.loans_gmv(lending(s, d).fct_loan),
    "q3_cohort_gmv": lambda s, d: answers.cohort_gmv(lending(s, d).fct_loan, COHORT),
    "q4_fpd30": _q4,
    "q5_par30_balance": lambda s, d: answers.par30(
        lending(s, d).dm_loan_delinquency_snapshot
    ),
    "q6_merchant_concentration": lambda s, d: answers.merchant_concentration(
        lending(s, d).stored_loan
    ),
    "q7_redundant_ids": lambda s, d: answers.redundant_ids(lending(s, d).dim_customer),
}
