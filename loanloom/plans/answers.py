"""The seven business answers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.money import MONEY, ratio
from loanloom.plans.lending import first_payment_flags


def applications_approval(applications: DataFrame) -> DataFrame:
    return applications.agg(
        F.count("*").alias("n_applications"),
        F.count_if(F.col("status") == "APPROVED").alias("n_approved"),
    ).withColumn("approval_rate", ratio(F.col("n_approved"), F.col("n_applications")))


def loans_gmv(loans: DataFrame) -> DataFrame:
    return loans.agg(
        F.count("*").alias("n_loans"),
        F.sum("principal_usd").cast(MONEY).alias("gmv_usd"),
    )


def cohort_gmv(loans: DataFrame, month: date) -> DataFrame:
    """Loans disbursed in one month, filtered by a date range that can prune."""
    first = F.lit(month)
    cohort = loans.where(
        (F.col("disbursement_date") >= first)
        & (F.col("disbursement_date") < F.add_months(first, 1))
    )
    return loans_gmv(cohort).select(first.alias("month"), "n_loans", "gmv_usd")


def fpd30(final: DataFrame, loans: DataFrame, cutoff: date, month: date) -> DataFrame:
    """First-payment default overall and for one disbursement cohort.

    One pass: a loan is counted under every population it belongs to.
    """
    first = first_payment_flags(final.where("installment_number = 1"), cutoff)
    dated = first.join(loans.select("loan_id", "disbursement_date"), "loan_id")
    in_cohort = F.trunc("disbursement_date", "month") == F.lit(month)
    label = F.lit(month.strftime("%Y-%m"))
    populations = F.when(in_cohort, F.array(F.lit("global"), label)).otherwise(
        F.array(F.lit("global"))
    )
    return (
        dated.withColumn("population", F.explode(populations))
        .groupBy("population")
        .agg(
            F.count_if("eligible").alias("fpd30_eligible"),
            F.count_if("defaulted").alias("fpd30_default"),
        )
        .withColumn("fpd30_rate", ratio(F.col("fpd30_default"), F.col("fpd30_eligible")))
        .orderBy(F.col("population") != "global", "population")
    )


def par30(snapshot: DataFrame) -> DataFrame:
    late = F.when(F.col("dpd") > 30, F.col("balance_usd")).otherwise(F.lit(0))
    return snapshot.agg(
        F.sum("balance_usd").cast(MONEY).alias("outstanding_usd"),
        F.sum(late).cast(MONEY).alias("outstanding_dpd_gt_30_usd"),
    ).withColumn(
        "par30_rate", ratio(F.col("outstanding_dpd_gt_30_usd"), F.col("outstanding_usd"))
    )


def merchant_concentration(loans: DataFrame, top: int = 5) -> DataFrame:
    """Largest merchants by GMV with their share and cumulative share.

    The top rows are taken first, so the unpartitioned window sees ``top`` rows.
    """
    gmv = loans.groupBy("merchant_id").agg(F.sum("principal_usd").alias("gmv"))
    total = loans.agg(F.sum("principal_usd").alias("total"))
    largest = gmv.orderBy(F.desc_nulls_last("gmv"), "merchant_id").limit(top)
    order = Window.orderBy(F.desc_nulls_last("gmv"), "merchant_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        largest.withColumn("total", total.scalar())
        .select(
            "merchant_id",
            F.col("gmv").cast(MONEY).alias("gmv_usd"),
            ratio(F.col("gmv"), F.col("total")).alias("gmv_share"),
            F.row_number().over(order).alias("gmv_rank"),
            ratio(F.sum("gmv").over(so_far), F.col("total")).alias("cumulative_share"),
        )
        .orderBy("gmv_rank")
    )


def redundant_ids(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count("*").alias("n_persons"),
        F.sum("customer_id_count").alias("n_customer_ids"),
        (F.sum("customer_id_count") - F.count("*")).alias("n_redundant_ids"),
    )
