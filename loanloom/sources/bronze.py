"""Text extracts: every CSV column stays text, duplicates stay in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the seven extracts, in file order.
EXTRACTS: dict[str, tuple[str, ...]] = {
    "raw_applications_cdc": (
        "application_id",
        "customer_id",
        "merchant_id",
        "requested_amount",
        "currency",
        "status",
        "approved_amount",
        "event_at_utc",
        "_op",
        "_ingested_at_utc",
    ),
    "raw_customers": (
        "customer_id",
        "document_number",
        "country",
        "city",
        "email",
        "birth_year",
        "monthly_income",
        "created_at",
        "_ingested_at",
    ),
    "raw_fx_rates": ("rate_date", "currency", "units_per_usd"),
    "raw_installments": ("loan_id", "installment_number", "due_date", "amount_due"),
    "raw_loans": (
        "loan_id",
        "application_id",
        "customer_id",
        "merchant_id",
        "principal",
        "currency",
        "term_months",
        "apr",
        "disbursed_at_utc",
        "status",
    ),
    "raw_merchants_history": (
        "merchant_id",
        "merchant_name",
        "category",
        "country",
        "valid_from",
    ),
    "raw_payments": (
        "payment_id",
        "loan_ref",
        "paid_at_utc",
        "amount_raw",
        "source_system",
        "payment_method",
        "status",
        "reversed_payment_id",
    ),
}

_CSV = {"header": "true", "quote": '"', "escape": '"'}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_extract(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """CSV with a header that must match; all columns text, empty fields null.

    ``multi_line`` is only for files with line breaks inside quotes, since such
    files cannot be split.
    """
    return (
        spark.read.schema(text_schema(columns))
        .options(**_CSV, enforceSchema="false", multiLine=str(multi_line).lower())
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a folder of headered CSV files, keeping spaces as they are."""
    df.write.mode("overwrite").options(
        **_CSV,
        emptyValue="",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)


def require_complete(
    spark: SparkSession, root: str, expected: Sequence[str] = tuple(EXTRACTS)
) -> None:
    """Fail unless ``<root>/raw_*.csv`` holds exactly the expected extracts."""
    listed = spark.read.format("binaryFile").load(f"{root}/raw_*.csv").select("path")
    name = F.regexp_extract("path", r"/(raw_[^/]+)\.csv(/[^/]*)?$", 1)
    # One entry per extract: the folder listing, not the data.
    found = {row[0] for row in listed.select(name).distinct().collect()}
    if found != set(expected):
        missing, extra = set(expected) - found, found - set(expected)
        raise FileNotFoundError(
            f"extracts missing: {sorted(missing)}, unexpected: {sorted(extra)}"
        )


def read_extracts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All extracts under a folder, after checking that the set is complete."""
    require_complete(spark, root)
    return {
        name: read_extract(spark, f"{root}/{name}.csv", columns)
        for name, columns in EXTRACTS.items()
    }


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
