"""Derived weather columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rain needs more than this depth, snow this average or colder.
RAIN_ABOVE_MM = 0.5
SNOW_UP_TO_CELSIUS = 1.0


def to_fahrenheit(celsius: Column) -> Column:
    return F.round(celsius * 9.0 / 5.0 + 32, 1)


def is_rainy(precipitation: Column) -> Column:
    return F.coalesce(precipitation > RAIN_ABOVE_MM, F.lit(False))


def is_snowy(precipitation: Column, average: Column) -> Column:
    wet_and_cold = (precipitation > RAIN_ABOVE_MM) & (average <= SNOW_UP_TO_CELSIUS)
    return F.coalesce(wet_and_cold, F.lit(False))
