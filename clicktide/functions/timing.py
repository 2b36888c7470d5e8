"""Timestamp expressions. The session time zone must be UTC."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND
_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def parse_ts(c: Column) -> Column:
    """Timestamp of an ISO text (or timestamp) column, null where it does not parse."""
    return c.try_cast("timestamp")


def day_text(ts: Column) -> Column:
    """`YYYY-MM-DD` of a timestamp."""
    return ts.cast("date").cast("string")


def partition_text(ts: Column) -> Column:
    """`YYYYMMDD` of a timestamp."""
    return F.date_format(ts, "yyyyMMdd")


def floor_micros(micros: Column, width: int) -> Column:
    """Start of the fixed-width slot a microsecond value falls into, also before 1970."""
    return micros - F.pmod(micros, F.lit(width))


def to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def place(micros: Column, tie: Column, tie_type: str) -> Column:
    """Time, then tie-break, as one value to compare; micros below 2 * 10^18.

    With a whole number as tie-break both fit one decimal, which a hash aggregate can keep in place; a
    struct would make Spark sort the rows first.
    """
    if tie_type not in _WHOLE_NUMBERS:
        return F.struct(micros.alias("at"), tie.alias("tie"))
    width = F.lit(Decimal(1 << 64)).cast("decimal(20,0)")
    shifted = tie.cast("decimal(20,0)") + F.lit(Decimal(1 << 63)).cast("decimal(20,0)")
    return (micros.cast("decimal(19,0)") * width + shifted).cast("decimal(38,0)")
