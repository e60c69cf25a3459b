"""Calendar columns and period arithmetic."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEKEND = (1, 7)  # Spark counts Sunday as 1, Saturday as 7

# Label -> first and last hour; every other hour is late night.
HOURS_OF_DAY = {
    "morning_rush": (6, 9),
    "midday": (10, 15),
    "evening_rush": (16, 19),
    "evening": (20, 21),
}
OTHER_HOURS = "late_night"


def add_calendar(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    """``<prefix>_date``, ``<prefix>_hour`` and ``<prefix>_day_of_week`` of ``ts``."""
    return df.withColumns(
        {
            f"{prefix}_date": F.to_date(ts),
            f"{prefix}_hour": F.hour(ts),
            f"{prefix}_day_of_week": F.dayofweek(ts),
        }
    )


def add_duration(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Whole seconds between two timestamps, as minutes with two decimals."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return df.withColumn(name, F.round(seconds / 60.0, 2))


def add_period(df: DataFrame, on: str) -> DataFrame:
    """Partition columns ``year`` and ``month`` of a date or timestamp."""
    return df.withColumns({"year": F.year(on), "month": F.month(on)})


def is_weekend(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(*WEEKEND), F.lit(False))


def add_weekend(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumns(
        {"day_of_week": F.dayofweek(date_col), "is_weekend": is_weekend(F.col(date_col))}
    )


def time_of_day(hour: Column) -> Column:
    label = None
    for name, (first, last) in HOURS_OF_DAY.items():
        inside = hour.between(first, last)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(OTHER_HOURS)


def lagged_period(day: Column, lag: int = 2) -> Column:
    """struct(year, month) of the latest month published ``lag`` months later."""
    latest = F.add_months(day.cast("date"), -lag)
    return F.struct(F.year(latest).alias("year"), F.month(latest).alias("month"))


def period_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def trailing_months(year: Column, month: Column, n: int) -> Column:
    """array<struct(year, month)>: the ``n`` months ending at (year, month), sorted."""
    last = period_start(year, month)
    firsts = F.sequence(F.add_months(last, 1 - n), last, F.expr("INTERVAL 1 MONTH"))
    return F.transform(
        firsts, lambda d: F.struct(F.year(d).alias("year"), F.month(d).alias("month"))
    )


def calendar_days(year: Column, month: Column) -> Column:
    """array<date> of all days of a month."""
    first = period_start(year, month)
    return F.sequence(first, F.last_day(first), F.expr("INTERVAL 1 DAY"))


def period_bounds(year: int, month: int | None = None) -> tuple[date, date]:
    """First day of the period and first day after it."""
    if month is None:
        return date(year, 1, 1), date(year + 1, 1, 1)
    return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


def shift_period(year: int, month: int, by: int) -> tuple[int, int]:
    index = year * 12 + (month - 1) + by
    return index // 12, index % 12 + 1


def latest_published(as_of: date, lag: int = 2) -> tuple[int, int]:
    """(year, month) of the latest month published by ``as_of``."""
    return shift_period(as_of.year, as_of.month, -lag)


def in_any_period(periods: Iterable[tuple[int, int]]) -> Column:
    """Partition predicate: the row's month is one of ``periods``; no row's if there are
    none.  Spelled out with OR, which a catalog can use to list only these partitions."""
    months = [f"(year = {int(y)} AND month = {int(m)})" for y, m in periods]
    return F.expr(" OR ".join(months) or "false")
