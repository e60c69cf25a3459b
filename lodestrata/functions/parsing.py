"""Packed observation fields to numbers, as native column expressions.

Fields are comma-separated text, numbers are scaled by ten.  Whatever cannot be
read gives the field's missing value, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the raw format.
MISSING_TEMPERATURE = "+9999,9"
MISSING_TEMPERATURE_DIGITS = ("+9999", "-9999", "9999")
MISSING_FROM = 999.0
SCALE = 10.0


def to_number(text: Column) -> Column:
    """Decimal text to double, anything else to null.  By way of a decimal, as a
    cast to double would also read 'NaN', '12d' and '0x1p3'."""
    return text.try_cast("decimal(18, 6)").cast("double")


def _text(packed: Column, position: int) -> Column:
    """Field ``position`` (from 0) as text; null when there is none."""
    return F.get(F.split(packed, ","), position)


def _field(packed: Column, position: int) -> Column:
    """Field ``position`` unscaled; null when the text is too short."""
    return to_number(_text(packed, position)) / SCALE


def _below_missing(value: Column) -> Column:
    """The value, null from 999 on.  Unlike a ``when`` over the value, this does
    not parse it twice."""
    return F.nullif(F.least(value, F.lit(MISSING_FROM)), F.lit(MISSING_FROM))


def parse_temperature(packed: Column, strict_sentinel: bool = False) -> Column:
    """'+0123,1' -> 12.3.  Only the exact text '+9999,9' counts as missing;
    ``strict_sentinel`` also drops 9999 readings with any other quality code."""
    if strict_sentinel:
        known = ~_text(packed, 0).isin(*MISSING_TEMPERATURE_DIGITS)
    else:
        known = packed != MISSING_TEMPERATURE
    return F.when(known, _field(packed, 0))


def parse_precipitation(packed: Column, period_hours: int | None = None) -> Column:
    """'HH,DDDD,C,Q' -> millimetres, 0.0 when absent, unreadable or 999 and more.

    Reports of different lengths (HH) overlap; ``period_hours`` keeps one length
    and counts the others as 0.0."""
    depth = _below_missing(_field(packed, 1))
    if period_hours is not None:
        depth = F.when(to_number(_text(packed, 0)) == period_hours, depth)
    return F.coalesce(depth, F.lit(0.0))


def parse_wind(packed: Column) -> Column:
    """'angle,q,type,SSSS,q' -> metres per second, null when unusable."""
    return _below_missing(_field(packed, 3))


def parse_observed_at(text: Column) -> Column:
    """ISO date-time text to a zone-less timestamp; null when unreadable."""
    return text.try_cast("timestamp_ntz")
