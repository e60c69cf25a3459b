"""Conditional aggregates and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def avg_where(condition: Column, value: Column) -> Column:
    """Mean over the rows that meet the condition; the others are left out, and
    ``value`` is not evaluated for them."""
    return F.avg(F.when(condition, value))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def round_doubles(df: DataFrame, scale: int = 2) -> DataFrame:
    """Round every double column, in one projection."""
    return df.select(
        *(
            F.round(f.name, scale).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else F.col(f.name)
            for f in df.schema
        )
    )
