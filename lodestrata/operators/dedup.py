"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Keep one row per ``keys``; nulls in a key compare equal.

    Without ``order`` the survivor is arbitrary.  With it, the first row in that
    order survives, which makes the result repeatable.

    A filter ``row_number() = 1`` drops copies in every task before the shuffle,
    so a key with any number of copies sends one row per task.  ``dropDuplicates``
    would do so too, but its ``first`` buffers add a flag per column to every
    shuffled row.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or keys[:1]))
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")
