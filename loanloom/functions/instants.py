"""Instants, local business dates and months.

An instant is a TIMESTAMP_NTZ holding the UTC wall clock, so no result depends
on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_ZONE = "America/Bogota"

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_DAY = r"^\d{4}-\d{2}-\d{2}"


def parse_utc(text: Column) -> Column:
    """Text in any of the feeds' three encodings → UTC instant.

    Whole numbers are epoch milliseconds. ``yyyy-MM-dd HH:mm:ss`` is a UTC wall
    clock. Anything else must start with a full date and is read as ISO 8601,
    UTC when it names no offset. Text that fits none of these is null.
    """
    value = F.trim(text)
    epoch = F.expr(_EPOCH)
    wall_clock = value.try_cast("timestamp_ntz")
    zoned = F.timestamp_add(
        "MICROSECOND", F.unix_micros(value.try_cast("timestamp")), epoch
    )
    return (
        F.when(
            value.rlike(r"^-?[0-9]+$"),
            F.timestamp_add("MILLISECOND", value.cast("bigint"), epoch),
        )
        .when(value.rlike(_DAY + " "), wall_clock)
        .when(value.rlike(_DAY + r"T.*([Zz]|[+-]\d{2}(:?\d{2})?)$"), zoned)
        .when(value.rlike(_DAY), wall_clock)
    )


def local_date(instant: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Calendar day of a UTC instant in the business zone.

    ``from_utc_timestamp`` looks the zone up once a query, ``convert_timezone`` once a row.
    Seconds are counted from the parts of the instant, so the session's zone plays no part.
    """
    minutes = F.hour(instant) * 60 + F.minute(instant)
    day = F.unix_date(F.to_date(instant)).cast("bigint") * 86400
    utc = F.timestamp_seconds(day + minutes * 60 + F.second(instant))
    clock = F.unix_seconds(F.from_utc_timestamp(utc, zone))
    return F.date_from_unix_date(F.floor(clock / 86400).cast("int"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_number(day: Column) -> Column:
    """Months counted from January of the year 0, so that months are dealt with as integers."""
    return F.year(day) * 12 + F.month(day) - 1


#: Years whose month-ends are listed, so that the many rows of a calendar look them up.
_LISTED_YEARS = range(1950, 2050)


def _listed(number: Column, as_type: str) -> Column:
    """Month-end of a ``month_number`` in the listed years; null for all others."""
    starts = [date(y, m, 1) for y in _LISTED_YEARS for m in range(1, 13)]
    ends = [str(start - timedelta(days=1)) for start in [*starts[1:], date(_LISTED_YEARS.stop, 1, 1)]]
    listed = F.split(F.lit(",".join(ends)), ",").cast(f"array<{as_type}>")
    return F.get(listed, number - _LISTED_YEARS.start * 12)


def month_end(number: Column) -> Column:
    """Last day of the month of a ``month_number``."""
    written = F.last_day(F.add_months(F.expr("date'0000-01-01'"), number))
    return F.coalesce(_listed(number, "date"), written)


def month_end_text(number: Column) -> Column:
    """``month_end`` as text."""
    return F.coalesce(_listed(number, "string"), month_end(number).cast("string"))


def month_numbers(first: Column, last: Column) -> Column:
    """Array of month numbers from ``first``'s month through ``last``'s month."""
    return F.sequence(month_number(first), month_number(last), F.lit(1))


def month_starts(first: Column, last: Column) -> Column:
    """Array of month starts from ``first``'s month through ``last``'s month."""
    return F.sequence(
        month_start(first), month_start(last), F.expr("interval 1 month")
    )


def require_month_end(cutoff: date) -> date:
    """Month-end tables are only defined at the last day of a month."""
    if (cutoff + timedelta(days=1)).day != 1:
        raise ValueError(f"cutoff {cutoff} is not the last day of a month")
    return cutoff
