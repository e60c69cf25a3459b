"""Check suites of the layers.

Tier 1 looks at files, tier 2 at rows; tier 2 runs only if no blocking tier-1
check failed.  Tier 2 is also there on its own, over any DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from lodestrata.operators import checks as c
from lodestrata.operators.rules import in_period
from lodestrata.sources.inventory import file_inventory, folders, partition_years
from lodestrata.sources.lake import Lake, StagedPeriod

# --- fixed values: table names, locations and thresholds -----------------------------

TRIP_SOURCE = ("nyc_tlc", "yellow")
GREEN_SOURCE = ("nyc_tlc", "green")
WEATHER_SOURCE = ("noaa_weather", "nyc_daily")
FEATURE_SOURCE = "features"
TRIP_TABLE = "yellow_taxi_trips"
WEATHER_TABLE = "nyc_weather_daily"
DAILY_TABLE = "trip_weather_daily"
HOURLY_TABLE = "location_hourly_features"

TRIP_COLUMNS_WITHOUT_NULLS = ("pickup_datetime", "pickup_location_id", "fare_amount")
TRIP_RANGES = (
    c.Range("fare_amount", 0, 1000, low_inclusive=False),
    c.Range("trip_distance", 0, 200, low_inclusive=False),
    c.Range("passenger_count", 1, 8),
    c.Range("pickup_location_id", 1, 265),
)


BYTES_PER_FILE = 8 * 1024 * 1024


@dataclass(frozen=True)
class FileLimits:
    """``max_files`` holds for small periods; above it, files must have
    ``bytes_per_file`` on average, so the count grows with the data and not with how
    Spark split it, and many tiny files still fail."""

    min_bytes: int
    max_files: int | None = None
    bytes_per_file: int = BYTES_PER_FILE


@dataclass(frozen=True)
class SuiteLimits:
    """Thresholds; lower them for small data."""

    bronze_trips: FileLimits = FileLimits(10_000_000, 5)
    bronze_weather: FileLimits = FileLimits(1000, 5)
    silver_trips: FileLimits = FileLimits(5_000_000, 200)
    silver_weather: FileLimits = FileLimits(1000, 50)
    gold: FileLimits = FileLimits(1000)
    min_rows: int = c.MIN_ROWS
    trend_tolerance: float = c.TREND_TOLERANCE
    null_columns: Sequence[str] = TRIP_COLUMNS_WITHOUT_NULLS
    max_null_fraction: float = c.MAX_NULL_FRACTION
    ranges: Sequence[c.Range] = TRIP_RANGES
    max_violation_fraction: float = c.MAX_VIOLATION_FRACTION
    fare_bounds: tuple[float, float] = (5, 50)
    expected_years: Sequence[int] = field(default_factory=tuple)  # empty: the years landed


DEFAULTS = SuiteLimits()


# --- tier 1 -----------------------------------------------------------------------


def file_checks(
    inventory: DataFrame,
    limits: FileLimits,
    layer: str,
    table_name: str,
    year: int,
    month: int | None,
    expected_years: Sequence[int] | None = None,
    partitions: DataFrame | None = None,
) -> DataFrame:
    """Files of the period, and with ``expected_years`` the table's partition years,
    taken from ``partitions`` or else the inventory."""
    wanted = [c.files_exist(), c.total_bytes(limits.min_bytes)]
    if limits.max_files is not None:
        wanted.append(c.file_count(1, limits.max_files, bytes_per_file=limits.bytes_per_file))
    if expected_years is not None:
        wanted.append(c.unexpected_partitions(expected_years))
    tables = {"files": in_period(inventory, year, month), "partitions": inventory if partitions is None else partitions}
    return c.run_checks(tables, wanted, layer, table_name, year, month)


def gated(tier_1: DataFrame, tier_2: Callable[[], DataFrame]) -> list[Row]:
    """Tier-1 rows, then tier-2 rows unless a blocking tier-1 check failed.

    Check rows are few, one per check; they are all that reaches the driver."""
    first = tier_1.collect()
    if any(not r.passed and r.severity == c.ERROR for r in first):
        return first
    return first + tier_2().collect()


# --- tier 2 -----------------------------------------------------------------------


def silver_trip_checks(
    trips: DataFrame, year: int, month: int, limits: SuiteLimits = DEFAULTS, pruned: bool = False
) -> DataFrame:
    """``pruned``: the trips are Parquet files, so statistics spare reading most of them."""
    checks = [
        c.row_count_floor(limits.min_rows),
        c.row_count_trend(year, month, limits.trend_tolerance),
        c.null_rates(limits.null_columns, limits.max_null_fraction),
        c.value_ranges(limits.ranges, limits.max_violation_fraction),
        c.dates_in_partition("pickup_date", year, month),
    ]
    tables = {
        "rows": in_period(trips, year, month),
        "history": c.trend_history(trips, year, month),
    }
    return c.run_checks(
        tables, checks, "silver", TRIP_TABLE, year, month, pruned=("rows",) if pruned else ()
    )


def silver_weather_checks(weather: DataFrame, year: int, month: int) -> DataFrame:
    checks = [c.calendar_completeness("date", year, month)]
    tables = {"rows": in_period(weather, year, month)}
    return c.run_checks(tables, checks, "silver", WEATHER_TABLE, year, month)


def gold_checks(
    daily: DataFrame, trips: DataFrame, year: int, month: int, limits: SuiteLimits = DEFAULTS
) -> DataFrame:
    low, high = limits.fare_bounds
    checks = [
        c.gold_reconciliation(),
        c.calendar_completeness("pickup_date", year, month, table="gold"),
        c.stat_bounds("avg(avg_fare)", low, high, "avg_fare", table="gold"),
    ]
    tables = {"gold": in_period(daily, year, month), "silver": in_period(trips, year, month)}
    return c.run_checks(tables, checks, "gold", DAILY_TABLE, year, month)


# --- suites over a lake --------------------------------------------------------------


def bronze_trip_suite(
    spark: SparkSession, lake: Lake, year: int, month: int, limits: SuiteLimits = DEFAULTS
) -> list[Row]:
    inventory = file_inventory(spark, lake.path("bronze", *TRIP_SOURCE), year=year, month=month)
    return file_checks(
        inventory, limits.bronze_trips, "bronze", TRIP_TABLE, year, month
    ).collect()


def bronze_weather_suite(
    spark: SparkSession, lake: Lake, year: int, month: int, limits: SuiteLimits = DEFAULTS
) -> list[Row]:
    """The raw weather is annual; the month is not looked at."""
    inventory = file_inventory(spark, lake.path("bronze", *WEATHER_SOURCE), year=year)
    return file_checks(
        inventory, limits.bronze_weather, "bronze", WEATHER_TABLE, year, None
    ).collect()


def _expected_years(
    spark: SparkSession, lake: Lake, source: tuple[str, str], year: int, limits: SuiteLimits
) -> list[int]:
    """The limits' years, or else the years that are landed and the run's own."""
    if limits.expected_years:
        return list(limits.expected_years)
    landed = {f.year for f in folders(spark, lake.path("bronze", *source))}
    return sorted({year} | (landed - {None}))


def _found(
    spark: SparkSession, lake: Lake, layer: str, name: str, path: str, staged: Sequence[StagedPeriod]
) -> tuple[str, Callable[[], DataFrame], Callable[[], DataFrame]]:
    """Where a period's files are, the partition years there will be, and the table as it will be: of a staged
    period, or else of what is published."""
    table = lake.table(layer, name)
    period = next((p for p in staged if p.table == table), None)
    if period is None:
        return path, lambda: partition_years(spark, path), lambda: spark.table(table)

    def years() -> DataFrame:
        return partition_years(spark, path).union(partition_years(spark, period.base)).distinct()

    return period.base, years, lambda: period.frame(spark)


def silver_trip_suite(
    spark: SparkSession,
    lake: Lake,
    year: int,
    month: int,
    limits: SuiteLimits = DEFAULTS,
    staged: Sequence[StagedPeriod] = (),
) -> list[Row]:
    """``staged``: periods to be judged before they are published, here and in the suites below."""
    path = lake.path("silver", *TRIP_SOURCE)
    root, partitions, trips = _found(spark, lake, "silver", TRIP_TABLE, path, staged)
    inventory = file_inventory(spark, root, year=year, month=month)
    years = _expected_years(spark, lake, TRIP_SOURCE, year, limits)
    return gated(
        file_checks(
            inventory, limits.silver_trips, "silver", TRIP_TABLE, year, month, years, partitions()
        ),
        lambda: silver_trip_checks(trips(), year, month, limits, pruned=True),
    )


def silver_weather_suite(
    spark: SparkSession,
    lake: Lake,
    year: int,
    month: int,
    limits: SuiteLimits = DEFAULTS,
    staged: Sequence[StagedPeriod] = (),
) -> list[Row]:
    """Files of the year, days of the month."""
    path = lake.path("silver", *WEATHER_SOURCE)
    root, partitions, weather = _found(spark, lake, "silver", WEATHER_TABLE, path, staged)
    inventory = file_inventory(spark, root, year=year)
    years = _expected_years(spark, lake, WEATHER_SOURCE, year, limits)
    return gated(
        file_checks(
            inventory, limits.silver_weather, "silver", WEATHER_TABLE, year, None, years, partitions()
        ),
        lambda: silver_weather_checks(weather(), year, month),
    )


def gold_suite(
    spark: SparkSession,
    lake: Lake,
    year: int,
    month: int,
    limits: SuiteLimits = DEFAULTS,
    staged: Sequence[StagedPeriod] = (),
) -> list[Row]:
    found = {
        name: _found(spark, lake, "gold", name, lake.path("gold", FEATURE_SOURCE, name), staged)
        for name in (DAILY_TABLE, HOURLY_TABLE)
    }
    files = [
        file_checks(
            file_inventory(spark, root, year=year, month=month), limits.gold, "gold", name, year, month
        )
        for name, (root, _, _) in found.items()
    ]
    return gated(
        files[0].unionByName(files[1]),
        lambda: gold_checks(
            found[DAILY_TABLE][2](), spark.table(lake.table("silver", TRIP_TABLE)), year, month, limits
        ),
    )


def verdict(results: Sequence[Row]) -> bool:
    """False iff a failed check is an error."""
    return all(r.passed or r.severity == c.WARN for r in results)
