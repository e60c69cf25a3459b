"""Filling of single gaps in an ordered series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interpolate_single_gaps(
    df: DataFrame, value: str, order: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """A null ``value`` becomes the mean of the previous and the next row's.

    Original values count, so of two nulls in a row neither is filled, nor is one
    at an end.  Neighbours are rows, not days.  ``order`` is a date; one series
    per ``partition_by``.

    A window over a whole series would put it into one task.  Here the series is
    cut into months.  Inside a month the neighbours are at hand; the first and
    last row of all months of a series, two per month, form a group of their own
    in which they find the neighbour across the seam.
    """
    month = F.trunc(order, "month")
    inner = Window.partitionBy(*partition_by, month).orderBy(order)
    across = Window.partitionBy(*partition_by, "_seam", F.when(~F.col("_seam"), month)).orderBy(
        order
    )
    here = F.lit(True)
    marked = df.withColumns(
        {
            "_first": F.lag(here).over(inner).isNull(),
            "_last": F.lead(here).over(inner).isNull(),
            "_before": F.lag(value).over(inner),
            "_after": F.lead(value).over(inner),
        }
    ).withColumn("_seam", F.col("_first") | F.col("_last"))
    linked = marked.withColumns(
        {
            "_before": F.when(F.col("_first"), F.lag(value).over(across)).otherwise(
                F.col("_before")
            ),
            "_after": F.when(F.col("_last"), F.lead(value).over(across)).otherwise(
                F.col("_after")
            ),
        }
    )
    filled = F.coalesce(F.col(value), (F.col("_before") + F.col("_after")) / 2.0)
    return linked.withColumn(value, filled).drop(
        "_first", "_last", "_before", "_after", "_seam"
    )
