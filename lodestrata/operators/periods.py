"""Work lists of months."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.calendar import in_any_period, lagged_period, period_start


def missing_periods(wanted: DataFrame, loaded: DataFrame) -> DataFrame:
    """Wanted (year, month) rows that are not loaded yet."""
    return wanted.join(loaded.select("year", "month").distinct(), ["year", "month"], "left_anti")


def month_range(frame: DataFrame, first: str, last: str) -> DataFrame:
    """(year, month) rows from the date ``first`` to ``last`` of each input row."""
    start, end = F.trunc(first, "month"), F.trunc(last, "month")
    months = frame.select(
        F.explode(
            # A range whose end comes first is empty; a sequence would raise.
            F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 MONTH")))
        ).alias("_month")
    )
    return months.select(F.year("_month").alias("year"), F.month("_month").alias("month"))


def backfill_periods(
    spark: SparkSession, start: date, as_of: date, loaded: DataFrame, lag: int = 2
) -> DataFrame:
    """Months from ``start`` to the latest one published by ``as_of`` that are
    not loaded."""
    latest = lagged_period(F.lit(as_of), lag)
    frame = spark.range(1).select(
        F.lit(start).alias("first"),
        period_start(latest["year"], latest["month"]).alias("last"),
    )
    return missing_periods(month_range(frame, "first", "last"), loaded)


def period_counts(df: DataFrame, periods: list[tuple[int, int]]) -> DataFrame:
    """Row count per listed (year, month); reads only those partitions."""
    return (
        df.filter(in_any_period(periods))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("n"))
    )
