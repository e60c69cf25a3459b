"""Row validation, period filters and reject counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodestrata.functions.calendar import period_bounds


@dataclass(frozen=True)
class Rule:
    """A named condition in SQL text.  A null result rejects the row, unless
    ``allow_null`` names a column whose null is acceptable."""

    name: str
    condition: str
    allow_null: str | None = None

    def text(self) -> str:
        if self.allow_null:
            return f"({self.allow_null} IS NULL OR {self.condition})"
        return f"({self.condition})"


def between(column: str, low: float, high: float, allow_null: bool = False) -> Rule:
    text = f"{column} BETWEEN {low} AND {high}"
    return Rule(f"{column}_range", text, column if allow_null else None)


def at_least(column: str, low: float, allow_null: bool = False) -> Rule:
    return Rule(f"{column}_floor", f"{column} >= {low}", column if allow_null else None)


def not_null(column: str) -> Rule:
    return Rule(f"{column}_present", f"{column} IS NOT NULL")


def later_than(later: str, earlier: str) -> Rule:
    return Rule(f"{later}_after_{earlier}", f"{later} > {earlier}")


def all_hold(rules: Sequence[Rule]) -> Column:
    return F.expr(" AND ".join(rule.text() for rule in rules) or "true")


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(all_hold(rules))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with ``failed_rules`` naming why."""
    names = ", ".join(f"IF({r.text()}, NULL, '{r.name}')" for r in rules)
    rejected = df.filter(~F.coalesce(all_hold(rules), F.lit(False)))
    return valid_rows(df, rules), rejected.withColumn(
        "failed_rules", F.expr(f"array_compact(array({names}))")
    )


def within(column: str, year: int, month: int | None = None) -> Column:
    """Date or timestamp inside the period, as a range a Parquet scan can use."""
    first, after = period_bounds(year, month)
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(after))


def in_period(
    df: DataFrame, year: int, month: int | None = None, on: str | None = None
) -> DataFrame:
    """Rows of one month, or of one year.

    Partition columns ``year`` and ``month`` are used where the input has them,
    so that only that period's files are read; ``on`` adds the range over the
    date itself.
    """
    present = {name.lower() for name in df.columns}
    wanted = {"year": year} if month is None else {"year": year, "month": month}
    partitioned = set(wanted) <= present
    if not partitioned and on is None:
        raise ValueError("no partition columns: name the date column with on=")
    condition = F.lit(True)
    if partitioned:
        for name, value in wanted.items():
            condition = condition & (F.col(name) == value)
    if on is not None:
        condition = condition & within(on, year, month)
    return df.filter(condition)


# --- reject counts ----------------------------------------------------------


def cleaning_report(
    conformed: DataFrame,
    rules: Sequence[Rule],
    on: str,
    year: int,
    month: int,
    keys: Sequence[str],
) -> DataFrame:
    """One row of exact counts per cleaning step.

    Rows are first counted per de-duplication key, which combines copies before
    the shuffle; rejected rows share one null key.
    """
    valid = F.coalesce(all_hold(rules), F.lit(False))
    inside = F.coalesce(within(on, year, month), F.lit(False))
    kept = F.col("_valid") & F.col("_inside")
    flagged = conformed.select(valid.alias("_valid"), inside.alias("_inside"), *keys)
    per_key = (
        flagged.select("_valid", "_inside", *(F.when(kept, F.col(k)).alias(k) for k in keys))
        .groupBy("_valid", "_inside", *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    counts = per_key.agg(
        rows(F.lit(True)).alias("rows_in"),
        rows(~F.col("_valid")).alias("invalid"),
        rows(F.col("_valid") & ~F.col("_inside")).alias("out_of_period"),
        (rows(kept) - F.count_if(kept)).alias("duplicates"),
        F.count_if(kept).alias("rows_out"),
    )
    share = F.round(F.col("invalid") / F.greatest(F.col("rows_in"), F.lit(1)) * 100, 1)
    return counts.withColumn("invalid_pct", share)


def observe_cleaning(
    conformed: DataFrame,
    observation: Observation,
    rules: Sequence[Rule],
    on: str,
    year: int,
    month: int,
) -> DataFrame:
    """Count the steps before de-duplication while the rows pass by.

    The counts need no pass of their own, but a stage run again after an
    executor loss counts its rows again.  ``rows_in`` tells: where it differs
    from the input's row count, use ``cleaning_report``.
    """
    valid = F.coalesce(all_hold(rules), F.lit(False))
    inside = F.coalesce(within(on, year, month), F.lit(False))
    return conformed.observe(
        observation,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(valid).alias("valid"),
        F.count_if(valid & inside).alias("in_period"),
    )
