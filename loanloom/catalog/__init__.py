"""The registered queries: every operator run over one folder of parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.catalog.lending import LENDING, Query, lending
from loanloom.catalog.operators import OPERATORS
from loanloom.catalog.triage import TRIAGE
from loanloom.plans.lending import int_installment_status


REGISTERED: dict[str, Query] = {**LENDING, **OPERATORS, **TRIAGE}


def present(df: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Plain output types, so any client compares results alike.

    Decimals become doubles, dates and instants text, lists of text one text
    joined by ``|``; all else is kept, and so are the columns ``kept``.
    """
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in kept:
            pass
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _int_installment_status(spark: SparkSession, folder: str) -> DataFrame:
    """The table of that name, made plain by the step, of which there are a tenth."""
    return int_installment_status(lending(spark, folder).ledger, shown=present)


def all_queries() -> dict[str, Query]:
    """The registered queries with plain output types."""

    def shown(query: Query) -> Query:
        return lambda spark, folder: present(query(spark, folder))

    queries = {**REGISTERED, "int_installment_status": _int_installment_status}
    return {name: shown(query) for name, query in queries.items()}
