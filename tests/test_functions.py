from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanloom.functions import lists, text
from loanloom.functions.instants import (
    local_date,
    month_end,
    month_end_text,
    month_numbers,
    parse_utc,
    require_month_end,
)
from loanloom.functions.money import (
    bucket,
    from_minor_units,
    parse_grouped_money,
    ratio,
    to_usd,
)


def values(spark, column, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_parse_utc(zoned):
    cases = {
        "2026-03-08 02:30:00": datetime(2026, 3, 8, 2, 30),
        " 2026-03-08 02:30:00.250 ": datetime(2026, 3, 8, 2, 30, 0, 250000),
        "2026-03-08T02:30:00Z": datetime(2026, 3, 8, 2, 30),
        "2026-11-01T01:30:00-05:00": datetime(2026, 11, 1, 6, 30),
        "2026-11-01T01:30:00+0530": datetime(2026, 10, 31, 20, 0),
        "2026-03-08T02:30:00": datetime(2026, 3, 8, 2, 30),
        "2026-03-08": datetime(2026, 3, 8),
        "1772937000000": datetime(2026, 3, 8, 2, 30),
        "-1": datetime(1969, 12, 31, 23, 59, 59, 999000),
        "2026-03-08 02:30:00-05:00": datetime(2026, 3, 8, 2, 30),
        "": None,
        "  ": None,
        "junk": None,
        "2026-01": None,
        "T05:00": None,
        "2026-13-40 00:00:00": None,
        None: None,
    }
    got = values(zoned, parse_utc(F.col("t")), [(c,) for c in cases], "t string")
    assert got == list(cases.values())


def test_local_date(zoned):
    cases = [
        (datetime(2026, 7, 1, 4, 59, 59), date(2026, 6, 30)),
        (datetime(2026, 7, 1, 5, 0, 0), date(2026, 7, 1)),
        (datetime(2026, 1, 1, 3, 0, 0), date(2025, 12, 31)),
        (None, None),
    ]
    got = values(zoned, local_date(F.col("t")), [(c[0],) for c in cases], "t timestamp_ntz")
    assert got == [c[1] for c in cases]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_local_date_looks_the_zone_up_once(zoned):
    """As ``convert_timezone`` has it, around clock changes and before 1970 too."""
    starts = [datetime(1992, 5, 3), datetime(1993, 4, 4), datetime(1951, 5, 6), datetime(1, 1, 1)]
    instants = [(s.replace(hour=h, minute=59, microsecond=999999),) for s in starts for h in range(9)]
    df = zoned.createDataFrame(instants, "t timestamp_ntz")
    plain = F.convert_timezone(F.lit("UTC"), F.lit("America/Bogota"), F.col("t"))
    assert df.where(local_date(F.col("t")) != F.to_date(plain)).isEmpty()
    # That function looks its zones up by name for every row.
    assert "convert_timezone" not in plan_of(df.select(local_date(F.col("t")))).lower()


def test_months(spark):
    cases = [(date(1999, 11, 30), date(2000, 3, 1)), (date(2001, 1, 1), date(2001, 1, 31)), (None, None)]
    got = spark.createDataFrame(cases, "a date, b date").select(
        F.transform(month_numbers(F.col("a"), F.col("b")), month_end).alias("v")
    )
    ends = [date(1999, 11, 30), date(1999, 12, 31), date(2000, 1, 31), date(2000, 2, 29)]
    assert [r.v for r in got.collect()] == [[*ends, date(2000, 3, 31)], [date(2001, 1, 31)], None]


def test_month_ends_as_text(spark):
    """Listed months and those before and after the list end alike, as days and as text."""
    number = F.col("id").cast("int")
    wanted = F.last_day(F.make_date((number / 12).cast("int"), number % 12 + 1, F.lit(1)))
    months = spark.range(1900 * 12, 2100 * 12).select(
        number.alias("n"),
        month_end(number).alias("day"),
        month_end_text(number).alias("text"),
        wanted.alias("wanted"),
    )
    assert months.where("day = wanted and text = cast(wanted as string)").count() == 200 * 12
    assert months.where(f"n = {2000 * 12 + 1}").first().text == "2000-02-29"
    none = spark.range(1).select(month_end_text(F.lit(None).cast("int")).alias("v"))
    assert none.first().v is None


def test_cutoff_must_be_month_end():
    assert require_month_end(date(2000, 2, 29))
    with pytest.raises(ValueError):
        require_month_end(date(2000, 6, 29))


def test_money(spark):
    got = values(
        spark,
        parse_grouped_money(F.col("t")),
        [("1,234.56",), ("N/A",), (" -7 ",), ("",), (None,)],
        "t string",
    )
    assert got == [Decimal("1234.56"), None, Decimal("-7.00"), None, None]
    assert values(spark, from_minor_units(F.col("t")), [("12345",)], "t string") == [
        Decimal("123.45")
    ]
    usd = to_usd(F.col("a"), F.col("r"))
    assert values(
        spark,
        usd,
        [(Decimal("10.00"), Decimal("3.000000")), (Decimal("10.00"), None)],
        "a decimal(18,2), r decimal(18,6)",
    ) == [Decimal("3.333333"), None]
    # The quotient is exactly 43683.7890625: decimal division sees the tie.
    tie = [(Decimal("91701.01"), Decimal("2.0992"))]
    assert values(spark, usd, tie, "a decimal(18,2), r decimal(18,6)") == [
        Decimal("43683.789063")
    ]


def test_unreadable_strict_amount_is_an_error(spark):
    with pytest.raises(Exception, match="not whole cents"):
        values(spark, from_minor_units(F.col("t")), [("x",)], "t string")


def test_ratio_and_bucket(spark):
    rows = [(1, 2), (1, 0), (0, 4), (None, 3)]
    assert values(spark, ratio(F.col("a"), F.col("b")), rows, "a int, b int") == [
        0.5,
        None,
        0.0,
        None,
    ]
    days = [(n,) for n in (0, 1, 30, 31, 60, 61, 90, 91)]
    assert values(spark, bucket(F.col("d"), (30, 60, 90)), days, "d int") == [
        "0", "1-30", "1-30", "31-60", "31-60", "61-90", "61-90", "90+",
    ]


def test_text(spark):
    rows = [("quiero cambiar",), ("me cambiaron",), ("cambiarán",), ("¿mover?",), ("re_mover",)]
    found = values(spark, text.has_word(F.col("t"), ["cambiar", "mover"]), rows, "t string")
    assert found == [True, False, False, True, False]
    blanks = [(" \t \n",), ("",), (None,), (" x ",)]
    assert values(spark, text.is_blank(F.col("t")), blanks, "t string") == [
        True, True, True, False,
    ]


def test_lists(spark):
    rows = [(["a", "b", "a", "c", "b"],), ([],), (["b", "b"],)]
    schema = "x array<string>"
    x = F.col("x")
    assert values(spark, lists.distinct_without(x, F.lit("b")), rows, schema) == [
        ["a", "c"], [], [],
    ]
    assert values(spark, lists.remove_first(x, "b"), rows, schema) == [
        ["a", "a", "c", "b"], [], ["b"],
    ]
    assert values(spark, lists.first_match(x, {"c": "1", "b": "2"}), rows, schema) == [
        "1", None, "2",
    ]
    assert values(spark, lists.evidenced(F.col("x"), F.lit("hola a y c")), rows, schema) == [
        ["a", "c"], [], [],
    ]
    kept = lists.evidenced(F.array(F.lit(""), F.lit("A"), F.lit("a")), F.lit("a"))
    assert values(spark, kept, rows[:1], schema) == [["", "A", "a"]]
