"""Scalar expressions over numbers, times and names. None depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: epoch numbers above this are milliseconds.
MILLIS_ABOVE = 100_000_000_000


def year_month(seconds: Column, zone: str = "UTC") -> Column:
    """Epoch seconds to the integer yyyyMM in the given zone."""
    if zone == "UTC":
        day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    else:
        instant = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            secs=seconds.cast("decimal(18,6)")
        )
        day = F.convert_timezone(F.lit("UTC"), F.lit(zone), instant).cast("date")
    return (F.year(day) * 100 + F.month(day)).cast("int")


def epoch_seconds(value: Column) -> Column:
    """Epoch seconds from a number that holds seconds or milliseconds."""
    number = value.cast("bigint")
    return F.when(number > MILLIS_ABOVE, F.floor(number / 1000)).otherwise(number).cast("bigint")


def normalise_score(raw: Column) -> Column:
    """A 1..10 raw star value to a 0.5..5 score with two decimals."""
    return F.round(raw / 2, 2)


def log_gain(count: Column) -> Column:
    """log10 of a count, with 0 counted as 1."""
    return F.log10(F.greatest(count, F.lit(1)).cast("double"))


def java_string_hash(text: Column) -> Column:
    """The 31-polynomial over UTF-16 code units, wrapped to a signed 32-bit integer."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("[0-9A-F]{4}"), F.lit(0))
    return F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda acc, unit: F.pmod(acc * 31 + F.conv(unit, 16, 10).cast("bigint"), F.lit(1 << 32)),
        lambda acc: F.when(acc >= 1 << 31, acc - (1 << 32)).otherwise(acc).cast("int"),
    )
