"""Strict casts and change-log ties."""

import re
from decimal import Decimal

import pytest
from conftest import FOLDER
from loanloom.catalog import REGISTERED
from loanloom.catalog.lending import lending, release
from loanloom.functions.money import MONEY, from_minor_units, readable, strict
from loanloom.operators.change_log import latest_state
from loanloom.plans.lending import EVENT_ORDER, typed_application_events
from loanloom.samples.lending import RawTables
from pyspark.sql import functions as F


@pytest.fixture(params=["true", "false"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(
    "text, kind",
    [("2026-01", "date"), ("12x", "bigint"), ("", "bigint"), (" ", "date"), ("1e3", "bigint"),
     ("1e3", MONEY), ("2026-02-30", "date"), ("99999999999999999999", "bigint")],
)
def test_refused(ansi, text, kind):
    df = ansi.createDataFrame([(text,)], "t string")
    assert df.select(readable(F.col("t"), kind)).first()[0] is None
    with pytest.raises(Exception, match="not a"):
        df.select(strict(F.col("t"), kind)).collect()


@pytest.mark.parametrize("text, kind", [(" 12 ", "bigint"), ("2026-01-31", "date"), ("1.50", MONEY)])
def test_read(ansi, text, kind):
    df = ansi.createDataFrame([(text,), (None,)], "t string")
    rows = [r[0] for r in df.select(strict(F.col("t"), kind)).collect()]
    assert str(rows[0]) == text.strip() and rows[1] is None


@pytest.mark.parametrize("text", ["12x", "12.5", "1e3", "", " ", "9999999999999999999", "9" * 18 + "0"])
def test_minor_units_refused(ansi, text):
    df = ansi.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="not whole cents"):
        df.select(from_minor_units(F.col("t"))).collect()


def test_minor_units_read(ansi):
    df = ansi.createDataFrame([(" 1250 ",), ("-5",), (None,)], "t string")
    got = [r[0] for r in df.select(from_minor_units(F.col("t"))).collect()]
    assert got == [Decimal("12.50"), Decimal("-0.05"), None]


#: Every shape that some cast takes, against the full shapes spelled out.
SHAPES = {
    "bigint": r"[+-]?[0-9]+",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    MONEY: r"[+-]?[0-9]+([.][0-9]*)?",
}


@pytest.mark.parametrize("kind", SHAPES)
def test_shapes(ansi, kind):
    texts = (
        "1 -1 +1 +-1 1. .5 -.5 +.5 5.5 1e3 1E3 1d 1f 1L 0x1 1_0 1,0 NaN inf - + . e1 ١ 5٥ "
        "2024 2024-1 2024-1-5 2024-01-5 2024-1-05 2024-01-05 2024-01-05T 2024-01-5T 2024-1-5T "
        "2024-01-05T00 02024-01-05 +2024-01-05 +024-01-05 -024-01-05 12024-01-05 24-01-05 "
        "2024/01/05 20240105 2024-01-05Z 2024-13-01 now today epoch"
    ).split() + ["2024-01-05 00:00:00", "2024-1-5 x", "2024-1-5 0", "1 0", "2024-01- 5"]
    df = ansi.createDataFrame([(t,) for t in texts], "t string")
    for text, value in df.select("t", readable(F.col("t"), kind)).collect():
        if not re.fullmatch(SHAPES[kind], text):
            assert value is None, text
        elif text not in ("2024-13-01", "12024-01-05"):
            assert value is not None, text


def test_tied_changes_in_the_sentinel_query(spark):
    """At one moment the delete's customer is reported, not the update's."""
    raw = RawTables(spark, FOLDER)
    changes = raw["raw_applications_cdc"]
    first = changes.where("_op = 'U'").orderBy("application_id").limit(1)
    tied = first.withColumns({"_op": F.lit("D"), "customer_id": F.lit("1")}).unionByName(
        first.withColumns({"_op": F.lit("I"), "customer_id": F.lit("2")})
    )
    release()
    tables = lending(spark, FOLDER)
    tables.raw = {**dict(raw), "raw_applications_cdc": changes.unionByName(tied)}
    try:
        key = first.first()["application_id"]
        got = REGISTERED["sentinel_resolution"](spark, FOLDER).where(f"application_id = {key}")
        assert [r.reported_customer_id for r in got.collect()] == [1]
    finally:
        release()


def test_delete_beats_update_beats_insert(spark):
    names = (
        "application_id customer_id merchant_id currency requested_amount approved_amount "
        "status event_at_utc _ingested_at_utc _op"
    ).split()
    at = "2024-01-01 00:00:00"
    rows = [
        (a, "1", "1", "COP", "1", "1", "APPROVED", at, at, op)
        for a, ops in (("1", "IUD"), ("2", "UI"), ("3", "DU"))
        for op in ops
    ]
    events = typed_application_events(spark.createDataFrame(rows, names))
    last = latest_state(events, ["application_id"], EVENT_ORDER).collect()
    assert {r["application_id"]: r["op"] for r in last} == {1: "D", 2: "U", 3: "D"}
