"""Data-quality checks as rows.

A check names the aggregates it needs (its facts, each over one of the tables it
is given) and how to judge them.  ``run_checks`` collects the facts of all checks
over a table into one aggregation, so a suite reads each table once, and returns
one row per check.

Of tables that are Parquet files, named by ``pruned``, facts that count unwanted rows
are taken from a scan for those rows alone: Spark skips the row groups and pages whose
statistics rule them out, and a plain row count needs no more than the footers.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.calendar import calendar_days, period_bounds, shift_period
from lodestrata.operators.periods import period_counts

ERROR = "error"
WARN = "warn"

CHECK_SCHEMA = (
    "layer string, table_name string, year int, month int, check_name string, "
    "passed boolean, message string, metric_value double, threshold double, severity string"
)

# Default thresholds.
MIN_ROWS = 1_000_000
TREND_TOLERANCE = 0.5
TREND_MONTHS = 3
MAX_NULL_FRACTION = 0.01
MAX_VIOLATION_FRACTION = 0.005
MIN_RETENTION = 0.5
MIN_BYTES = 1000
MIN_FILES, MAX_FILES = 1, 1000
MAX_AGE_HOURS = 48

NO_ROWS = "no rows in the period"
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


class Fact(NamedTuple):
    table: str
    aggregate: Column
    where: Column | None = None  # set if the aggregate counts the rows where this holds


@dataclass(frozen=True)
class Check:
    name: str
    facts: Mapping[str, Fact]
    passed: Column  # over the fact names
    message: Column
    metric: Column = field(default_factory=lambda: F.lit(None))
    threshold: Column = field(default_factory=lambda: F.lit(None))
    severity: str = ERROR

    def row(self) -> Column:
        return F.struct(
            F.lit(self.name).alias("check_name"),
            F.coalesce(self.passed, F.lit(False)).alias("passed"),
            self.message.alias("message"),
            self.metric.cast("double").alias("metric_value"),
            self.threshold.cast("double").alias("threshold"),
            F.lit(self.severity).alias("severity"),
        )


def run_checks(
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check],
    layer: str,
    table_name: str,
    year: int,
    month: int | None,
    pruned: Sequence[str] = (),
) -> DataFrame:
    """Check rows, in the order of ``checks``.  ``tables`` are already restricted
    to the rows each fact is about; ``pruned`` names those that are Parquet files, whose
    statistics then spare reading them."""
    per_table: dict[str, dict[str, Fact]] = {}
    for check in checks:
        for name, given in check.facts.items():
            fact = Fact(*given)
            known = per_table.setdefault(fact.table, {}).setdefault(name, fact)
            if str(known.aggregate) != str(fact.aggregate):
                raise ValueError(f"two checks mean different things by {name}")
    measured = [
        part for table, facts in per_table.items()
        for part in _measured(tables[table], facts, table in pruned)
    ]
    facts = measured[0]
    if len(measured) > 1:
        # One row per table; every fact is set in exactly one of them.
        for other in measured[1:]:
            facts = facts.unionByName(other, allowMissingColumns=True)
        facts = facts.agg(*(F.max(c).alias(c) for c in facts.columns))
    rows = facts.select(F.inline(F.array(*(check.row() for check in checks))))
    return rows.select(
        F.lit(layer).alias("layer"),
        F.lit(table_name).alias("table_name"),
        F.lit(year).cast("int").alias("year"),
        F.lit(month).cast("int").alias("month"),
        "*",
    )


def _measured(df: DataFrame, facts: Mapping[str, Fact], pruned: bool) -> list[DataFrame]:
    """The facts of one table as one row; if it is pruned, as up to three: the row count,
    counts of unwanted rows, and whatever has to see every row."""
    def plain(name: str) -> bool:
        return name == f"{facts[name].table}_rows"

    groups = [list(facts)]
    if pruned:
        unwanted = [n for n in facts if facts[n].where is not None]
        rest = [n for n in facts if facts[n].where is None and not plain(n)]
        groups = [[n for n in facts if plain(n)], unwanted, rest]
    out = []
    for names in filter(None, groups):
        conditions = [facts[n].where for n in names]
        rows = df.filter(reduce(or_, conditions)) if pruned and conditions[0] is not None else df
        out.append(rows.agg(*(facts[n].aggregate.alias(n) for n in names)))
    return out


def _rows(table: str) -> dict[str, Fact]:
    return {f"{table}_rows": Fact(table, F.count(F.lit(1)))}


def _rows_where(table: str, condition: Column) -> Fact:
    return Fact(table, F.count_if(condition), condition)


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _label(year: int, month: int) -> str:
    return f"{year}-{month:02d}"


# --- content of one table -----------------------------------------------------


def row_count_floor(min_rows: int = MIN_ROWS, table: str = "rows") -> Check:
    n = F.col(f"{table}_rows")
    return Check(
        "row_count_floor",
        _rows(table),
        n >= min_rows,
        F.format_string(f"%,d rows, at least {min_rows:,} wanted", n),
        n,
        F.lit(min_rows),
    )


def row_count_trend(
    year: int, month: int, tolerance: float = TREND_TOLERANCE, table: str = "history"
) -> Check:
    """Month against the mean of the three months before.  ``table`` holds counts
    per month, see ``trend_history``."""
    months = trend_months(year, month)
    names = [f"{table}_{y}_{m}" for y, m in months]
    facts = {
        name: Fact(table, F.coalesce(F.sum(F.when(_is(y, m), F.col("n"))), F.lit(0)))
        for name, (y, m) in zip(names, months)
    }
    *before, current = (F.col(name) for name in names)
    filled = sum((F.when(n > 0, 1).otherwise(0) for n in before), F.lit(0))
    mean = sum(before, F.lit(0)).cast("double") / TREND_MONTHS
    judged = filled == TREND_MONTHS
    low, high = mean * (1 - tolerance), mean * (1 + tolerance)
    return Check(
        "row_count_trend",
        facts,
        ~judged | current.between(low, high),
        F.when(
            judged,
            F.format_string(
                "%,d rows against a mean of %,.0f before (%,.0f to %,.0f allowed)",
                current, mean, low, high,
            ),
        ).otherwise(F.format_string("only %d earlier months, trend not judged", filled)),
        F.when(judged, current),
        F.when(judged, mean),
        WARN,
    )


def _is(year: int, month: int) -> Column:
    return (F.col("year") == year) & (F.col("month") == month)


def trend_months(year: int, month: int) -> list[tuple[int, int]]:
    return [shift_period(year, month, -back) for back in range(TREND_MONTHS, -1, -1)]


def trend_history(df: DataFrame, year: int, month: int) -> DataFrame:
    return period_counts(df, trend_months(year, month))


def _worst(shares: Mapping[str, Column], limit: float) -> tuple[Column, Column]:
    """All shares within the limit, and text naming those that are not."""
    within = F.lit(True)
    for share in shares.values():
        within = within & (share <= limit)
    named = F.array_compact(
        F.array(
            *(
                F.when(share > limit, F.format_string(f"{name}=%.2f%%", share * 100))
                for name, share in shares.items()
            )
        )
    )
    return within, F.array_join(named, ", ")


def null_rates(
    columns: Sequence[str], max_fraction: float = MAX_NULL_FRACTION, table: str = "rows"
) -> Check:
    n = F.col(f"{table}_rows")
    facts = _rows(table) | {
        f"{table}_null_{c}": _rows_where(table, F.col(c).isNull()) for c in columns
    }
    shares = {c: _share(F.col(f"{table}_null_{c}"), n) for c in columns}
    within, named = _worst(shares, max_fraction)
    return Check(
        "null_rates",
        facts,
        (n > 0) & within,
        F.when(n == 0, NO_ROWS)
        .when(within, f"{len(columns)} columns hold at most {max_fraction:.1%} nulls")
        .otherwise(F.concat(F.lit(f"more than {max_fraction:.1%} nulls: "), named)),
    )


@dataclass(frozen=True)
class Range:
    column: str
    low: float
    high: float
    low_inclusive: bool = True
    high_inclusive: bool = True

    def __str__(self) -> str:
        left, right = "[" if self.low_inclusive else "(", "]" if self.high_inclusive else ")"
        return f"{self.column} in {left}{self.low}, {self.high}{right}"

    @property
    def fact(self) -> str:
        """Column and bounds as a name."""
        return re.sub(r"[^A-Za-z0-9_]", lambda m: f"_{ord(m[0])}_", str(self))

    def violated(self) -> Column:
        value = F.col(self.column)
        below = value < self.low if self.low_inclusive else value <= self.low
        above = value > self.high if self.high_inclusive else value >= self.high
        return below | above


def value_ranges(
    ranges: Sequence[Range],
    max_fraction: float = MAX_VIOLATION_FRACTION,
    table: str = "rows",
) -> Check:
    """A null is in no range's way.  A column may have several ranges."""
    n = F.col(f"{table}_rows")
    columns = [r.column for r in ranges]
    facts = _rows(table) | {
        f"{table}_off_{r.fact}": _rows_where(table, r.violated()) for r in ranges
    }
    shares = {
        r.column if columns.count(r.column) == 1 else str(r): _share(F.col(f"{table}_off_{r.fact}"), n)
        for r in ranges
    }
    within, named = _worst(shares, max_fraction)
    return Check(
        "value_ranges",
        facts,
        (n > 0) & within,
        F.when(n == 0, NO_ROWS)
        .when(within, f"{len(ranges)} ranges are left by at most {max_fraction:.1%} of the rows")
        .otherwise(F.concat(F.lit(f"ranges left by more than {max_fraction:.1%}: "), named)),
    )


def dates_in_partition(date_col: str, year: int, month: int, table: str = "rows") -> Check:
    day = F.col(date_col)
    stray = F.col(f"{table}_stray_dates")
    first, after = period_bounds(year, month)
    outside = (day < F.lit(first)) | (day >= F.lit(after))  # a range that a scan can use
    return Check(
        "dates_in_partition",
        {f"{table}_stray_dates": _rows_where(table, outside)},
        stray == 0,
        F.format_string(f"%,d rows dated outside {_label(year, month)}", stray),
        stray,
        F.lit(0),
    )


def calendar_completeness(date_col: str, year: int, month: int, table: str = "rows") -> Check:
    """Every day of the month is there; the message lists the days that are not.
    The day set holds the month's days only, so it has 31 members at most."""
    day = F.col(date_col).cast("date")
    first, after = period_bounds(year, month)
    days = (after - first).days
    in_month = (day >= F.lit(first)) & (day < F.lit(after))
    present, seen = F.col(f"{table}_days"), F.col(f"{table}_day_set")
    absent = F.array_except(calendar_days(F.lit(year), F.lit(month)), seen)
    return Check(
        "calendar_completeness",
        {
            f"{table}_days": Fact(table, F.count_distinct(day)),
            f"{table}_day_set": Fact(table, F.collect_set(F.when(in_month, day))),
        },
        present == days,
        F.when(present == days, f"all {days} days present").otherwise(
            F.concat(
                F.format_string(f"%d of {days} days present, missing: ", present),
                F.array_join(F.transform(absent, lambda d: d.cast("string")), ", "),
            )
        ),
        present,
        F.lit(days),
    )


def stat_bounds(
    metric_sql: str, low: float, high: float, metric_name: str = "metric", table: str = "rows"
) -> Check:
    """An aggregate, given as SQL text, lies in its bounds."""
    value = F.col(f"{table}_{metric_name}")
    return Check(
        "stat_bounds",
        {f"{table}_{metric_name}": Fact(table, F.expr(metric_sql).cast("double"))},
        value.between(low, high),
        F.when(value.isNull(), NO_ROWS).otherwise(
            F.format_string(f"{metric_name}=%.2f, {low} to {high} expected", value)
        ),
        value,
        F.lit(high),
        WARN,
    )


# --- two tables compared --------------------------------------------------------


def cross_layer_counts(
    min_retention: float = MIN_RETENTION, bronze: str = "bronze", silver: str = "silver"
) -> Check:
    raw, clean = F.col(f"{bronze}_rows"), F.col(f"{silver}_rows")
    kept = _share(clean, raw)
    return Check(
        "cross_layer_counts",
        _rows(bronze) | _rows(silver),
        (raw > 0) & (clean <= raw) & (kept >= min_retention),
        F.when(raw == 0, "raw layer is empty, layers not comparable").otherwise(
            F.format_string(
                f"%,d of %,d rows kept (%.1f%%, at least {min_retention * 100:g}%% wanted)",
                clean, raw, kept * 100,
            )
        ),
        kept,
        F.when(raw > 0, F.lit(min_retention)),
    )


def gold_reconciliation(
    trips_col: str = "total_trips", gold: str = "gold", silver: str = "silver"
) -> Check:
    total, rows = F.col(f"{gold}_trips"), F.col(f"{silver}_rows")
    return Check(
        "gold_reconciliation",
        _rows(silver) | {f"{gold}_trips": Fact(gold, F.sum(trips_col))},
        total == rows,
        F.when(total.isNull(), NO_ROWS).otherwise(
            F.format_string("%,d trips in the features, %,d cleaned rows", total, rows)
        ),
        total,
        rows,
    )


# --- files (over sources.inventory.file_inventory) ----------------------------------


def files_exist(table: str = "files") -> Check:
    n = F.col(f"{table}_count")
    return Check(
        "s3_object_exists",
        _file_count(table),
        n > 0,
        F.format_string("%,d files found", n),
    )


def _file_count(table: str) -> dict[str, Fact]:
    return {f"{table}_count": Fact(table, F.coalesce(F.sum("files"), F.lit(0)))}


def total_bytes(min_bytes: int = MIN_BYTES, table: str = "files") -> Check:
    size = F.col(f"{table}_bytes")
    return Check(
        "s3_file_size",
        {f"{table}_bytes": Fact(table, F.sum("bytes"))},
        size >= min_bytes,
        F.when(size.isNull(), "no files found").otherwise(
            F.format_string(f"%,d bytes, at least {min_bytes:,} wanted", size)
        ),
        size,
        F.when(size.isNotNull(), F.lit(min_bytes)),
    )


def file_count(
    min_files: int = MIN_FILES,
    max_files: int = MAX_FILES,
    table: str = "files",
    bytes_per_file: int | None = None,
) -> Check:
    """``max_files`` holds for small data.  With ``bytes_per_file`` more files are allowed
    as long as they have that many bytes on average."""
    n = F.col(f"{table}_count")
    facts = _file_count(table)
    most = F.lit(max_files)
    if bytes_per_file is not None:
        facts |= {f"{table}_bytes": Fact(table, F.sum("bytes"))}
        size = F.coalesce(F.col(f"{table}_bytes"), F.lit(0))
        most = F.greatest(F.lit(max_files).cast("bigint"), F.ceil(size / F.lit(bytes_per_file)))
    return Check(
        "s3_file_count",
        facts,
        n.between(F.lit(min_files), most),
        F.format_string(f"%,d files, {min_files} to %,d wanted", n, most),
        n,
    )


def freshness(
    max_age_hours: float = MAX_AGE_HOURS, now: Column | None = None, table: str = "files"
) -> Check:
    newest = F.col(f"{table}_newest")
    now = F.current_timestamp() if now is None else now
    hours = (F.unix_micros(now) - F.unix_micros(newest)) / 3.6e9
    return Check(
        "s3_freshness",
        {f"{table}_newest": Fact(table, F.max("newest"))},
        hours <= max_age_hours,
        F.when(newest.isNull(), "no files found").otherwise(
            F.format_string(f"newest file is %.1f hours old, at most {max_age_hours} wanted", hours)
        ),
        hours,
        F.when(newest.isNotNull(), F.lit(max_age_hours)),
    )


def unexpected_partitions(expected_years: Sequence[int], table: str = "partitions") -> Check:
    """No partition year but the expected ones; a row per file partition, or any
    table with a ``year`` column, will do."""
    stray = F.col(f"{table}_stray_years")
    year = F.coalesce(F.col("year").cast("string"), F.lit(HIVE_NULL))
    expected = [str(y) for y in expected_years]
    return Check(
        "no_unexpected_partitions",
        {
            f"{table}_stray_years": Fact(
                table,
                F.collect_set(F.when(~year.isin(*expected), year)),
            )
        },
        F.size(stray) == 0,
        F.when(F.size(stray) == 0, f"only {', '.join(expected)} present").otherwise(
            F.concat(
                F.lit("partitions of other years: "), F.array_join(F.array_sort(stray), ", ")
            )
        ),
    )


# --- verdict -------------------------------------------------------------------


def evaluate_checks(results: DataFrame) -> DataFrame:
    """One row: ``passed`` is false iff a failed check is an error."""
    failed = ~F.col("passed")
    blocking = F.count_if(failed & (F.col("severity") != WARN))
    return results.agg(
        (blocking == 0).alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        blocking.alias("failed_errors"),
        F.count_if(failed & (F.col("severity") == WARN)).alias("failed_warnings"),
    )
