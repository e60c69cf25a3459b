"""The monthly run: land, clean, build features, with checks in between."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from lodestrata.operators.checks import CHECK_SCHEMA
from lodestrata.operators.contract import conform
from lodestrata.operators.rules import cleaning_report, observe_cleaning
from lodestrata.plans import suites
from lodestrata.plans.trips import (
    TRIP_KEYS,
    TRIP_RULES,
    TRIPS,
    clean_conformed,
    location_hourly_features,
    trip_weather_daily,
)
from lodestrata.plans.weather import clean_weather, observations_to_daily
from lodestrata.session import shuffles_sized_for
from lodestrata.sources.commit import described, discard, recover, replace_folder
from lodestrata.sources.inventory import data_files, entries, folders, is_complete
from lodestrata.sources.lake import (
    Lake,
    StagedPeriod,
    cause_of,
    land_periods,
    publish_period,
    read_observations,
    read_partition,
    stage_period,
)


class QualityError(Exception):
    """A suite failed; the run stops here."""

    def __init__(self, suite: str, results: list[Row]):
        failed = [f"{r.check_name}: {r.message}" for r in results if not r.passed]
        super().__init__(f"{suite}: " + "; ".join(failed))
        self.results = results


@dataclass
class CleaningReport:
    rows_in: int
    invalid: int
    out_of_period: int
    duplicates: int
    rows_out: int

    @property
    def invalid_pct(self) -> float:
        return round(self.invalid / max(self.rows_in, 1) * 100, 1)


@dataclass
class MonthOutcome:
    year: int
    month: int
    landed: dict[str, dict] = field(default_factory=dict)
    cleaning: CleaningReport | None = None
    rows: dict[str, int] = field(default_factory=dict)
    checks: dict[str, list[Row]] = field(default_factory=dict)


# --- steps ----------------------------------------------------------------------


def land_weather(
    spark: SparkSession,
    lake: Lake,
    csv_path: str,
    year: int,
    skip_existing: bool = True,
    through: date | None = None,
) -> dict:
    """Daily weather of a year's observations; returns an outcome as ``land_periods`` does.

    The file's year is the partition, whatever its rows say, as for trips.  A year that
    is there is skipped, unless it ends before ``through``: the file of a running year
    grows, and is then read again."""
    target = lake.path("bronze", *suites.WEATHER_SOURCE)
    path = f"{target}year={year}"
    outcome = {
        "year": year, "month": None, "success": True, "skipped": False,
        "path": path, "rows": None, "error": None,
    }
    try:
        recover(spark, target, path)
        there = [f for f in folders(spark, target, year) if f.month is None]
        path = outcome["path"] = there[0].path if there else path
        if skip_existing and there and is_complete(spark, path) and _reaches(spark, path, through):
            outcome["skipped"] = True
            return outcome
        files = entries(spark, csv_path)
        with shuffles_sized_for(spark, sum(e.length for e in files)):
            daily = observations_to_daily(read_observations(spark, csv_path))
            outcome["rows"] = replace_folder(
                spark,
                target,
                path,
                lambda staged: daily.hint("rebalance").write.parquet(staged),
                described(files),
                others=[f.path for f in there[1:]],
            )
    except Exception as failure:
        outcome.update(success=False, error=cause_of(failure))
    return outcome


def _reaches(spark: SparkSession, path: str, through: date | None) -> bool:
    if through is None:
        return True
    last = spark.read.parquet(path).agg(F.max("date")).first()[0]
    return last is not None and last >= through


def stage_silver_trips(
    spark: SparkSession, lake: Lake, year: int, month: int
) -> tuple[StagedPeriod, CleaningReport]:
    """Clean and write one month of trips in one pass over the raw rows, ready to be published."""
    raw, size = _raw_month(spark, lake, year, month)
    conformed = conform(raw, TRIPS)
    counts = Observation()
    observed = observe_cleaning(conformed, counts, TRIP_RULES, "pickup_datetime", year, month)
    with shuffles_sized_for(spark, size):
        period = stage_period(
            clean_conformed(observed, year, month, _survivor(conformed)),
            lake.table("silver", suites.TRIP_TABLE),
            lake.path("silver", *suites.TRIP_SOURCE),
            {"year": year, "month": month},
        )
    seen, written = counts.get, period.rows
    # The row count of Parquet files comes from their footers.
    if seen.get("rows_in") == raw.count():
        return period, CleaningReport(
            rows_in=seen["rows_in"],
            invalid=seen["rows_in"] - seen["valid"],
            out_of_period=seen["valid"] - seen["in_period"],
            duplicates=seen["in_period"] - written,
            rows_out=written,
        )
    # A stage ran twice and counted twice: count again.
    return period, exact_report(conformed, year, month)


def silver_trips(spark: SparkSession, lake: Lake, year: int, month: int) -> CleaningReport:
    """One month of cleaned trips, published without checks."""
    period, report = stage_silver_trips(spark, lake, year, month)
    publish_period(spark, period)
    return report


def exact_report(conformed: DataFrame, year: int, month: int) -> CleaningReport:
    counts = cleaning_report(conformed, TRIP_RULES, "pickup_datetime", year, month, TRIP_KEYS)
    return CleaningReport(**counts.drop("invalid_pct").first().asDict())


def _raw_month(spark: SparkSession, lake: Lake, year: int, month: int) -> tuple[DataFrame, int]:
    """The month's raw rows and the bytes of their files."""
    root = lake.path("bronze", *suites.TRIP_SOURCE)
    size = sum(e.length for f in folders(spark, root, year, month) for e in data_files(spark, f.path))
    if not size:
        raise FileNotFoundError(f"no raw trips of {year}-{month:02d}")
    return read_partition(spark, root, year, month).drop("year", "month"), size


def _survivor(conformed: DataFrame) -> list:
    """An order over all columns but the keys, so that of rows with equal keys the same
    one stays in every run."""
    return [
        F.col(f"`{f.name}`") for f in conformed.schema
        if f.name not in TRIP_KEYS and isinstance(f.dataType, AtomicType)
    ]


def stage_silver_weather(spark: SparkSession, lake: Lake, year: int) -> StagedPeriod:
    raw = read_partition(spark, lake.path("bronze", *suites.WEATHER_SOURCE), year)
    return stage_period(
        clean_weather(raw.drop("year"), year),
        lake.table("silver", suites.WEATHER_TABLE),
        lake.path("silver", *suites.WEATHER_SOURCE),
        {"year": year},
    )


def silver_weather(spark: SparkSession, lake: Lake, year: int) -> int:
    """A year of cleaned weather, published without checks."""
    return publish_period(spark, stage_silver_weather(spark, lake, year))


def stage_gold_features(spark: SparkSession, lake: Lake, year: int, month: int) -> list[StagedPeriod]:
    trips = spark.table(lake.table("silver", suites.TRIP_TABLE))
    weather = spark.table(lake.table("silver", suites.WEATHER_TABLE))
    frames = {
        suites.DAILY_TABLE: trip_weather_daily(trips, weather, year, month),
        suites.HOURLY_TABLE: location_hourly_features(trips, year, month),
    }
    root = lake.path("silver", *suites.TRIP_SOURCE)
    size = sum(e.length for f in folders(spark, root, year, month) for e in data_files(spark, f.path))
    periods: list[StagedPeriod] = []
    try:
        with shuffles_sized_for(spark, size):
            for name, frame in frames.items():
                path = lake.path("gold", suites.FEATURE_SOURCE, name)
                periods.append(
                    stage_period(frame, lake.table("gold", name), path, {"year": year, "month": month})
                )
    except Exception:
        _discard(spark, periods)
        raise
    return periods


def gold_features(spark: SparkSession, lake: Lake, year: int, month: int) -> dict[str, int]:
    """A month of both feature tables, published without checks."""
    return _publish(spark, stage_gold_features(spark, lake, year, month))


def _publish(spark: SparkSession, periods: Sequence[StagedPeriod]) -> dict[str, int]:
    return {p.table.rpartition(".")[2]: publish_period(spark, p) for p in periods}


def _discard(spark: SparkSession, periods: Sequence[StagedPeriod]) -> None:
    for p in periods:
        discard(spark, p.staged)


# --- the run ----------------------------------------------------------------------


def run_month(
    spark: SparkSession,
    lake: Lake,
    year: int,
    month: int,
    trips_landing: str,
    weather_csv: str,
    limits: suites.SuiteLimits = suites.DEFAULTS,
    skip_existing: bool = True,
    history_table: str | None = None,
) -> MonthOutcome:
    """Raises ``QualityError`` at the first suite that fails; the tables it is about are then as they
    were.  Check rows, also of the failed suite, are appended to ``history_table``."""
    outcome = MonthOutcome(year, month)

    def check(name: str, suite: Callable[..., list[Row]], staged: Sequence[StagedPeriod] | None = None) -> None:
        about = () if staged is None else (staged,)
        results = suite(spark, lake, year, month, limits, *about)
        outcome.checks[name] = results
        if history_table:
            rows = spark.createDataFrame(results, CHECK_SCHEMA)
            rows.write.mode("append").saveAsTable(history_table)
        if not suites.verdict(results):
            raise QualityError(name, results)

    lake.create_layers(spark)
    for source in (suites.TRIP_SOURCE, suites.GREEN_SOURCE):
        outcome.landed[source[1]] = land_periods(
            spark,
            trips_landing,
            lake.path("bronze", *source),
            [(year, month)],
            skip_existing,
            name_pattern=source[1] + "_*_{year}-{month:02d}.parquet",
        )[0]
    # Green trips are only kept; the run does not depend on them.
    landed = outcome.landed[suites.TRIP_SOURCE[1]]
    if not landed["success"]:
        raise FileNotFoundError(f"landing {year}-{month:02d}: {landed['error']}")
    last = date(year, month, monthrange(year, month)[1])
    outcome.landed["weather"] = land_weather(spark, lake, weather_csv, year, skip_existing, last)
    if not outcome.landed["weather"]["success"]:
        raise RuntimeError(f"landing weather of {year}: {outcome.landed['weather']['error']}")
    check("bronze_trips", suites.bronze_trip_suite)
    check("bronze_weather", suites.bronze_weather_suite)

    # Each layer is checked before it is published: a month that fails keeps its old rows.
    trips, cleaning = stage_silver_trips(spark, lake, year, month)
    staged = [trips]
    try:
        staged.append(stage_silver_weather(spark, lake, year))
        outcome.cleaning = cleaning
        check("silver_trips", suites.silver_trip_suite, staged)
        check("silver_weather", suites.silver_weather_suite, staged)
    except Exception:
        _discard(spark, staged)
        raise
    outcome.rows.update(_publish(spark, staged))

    staged = stage_gold_features(spark, lake, year, month)
    try:
        check("gold", suites.gold_suite, staged)
    except Exception:
        _discard(spark, staged)
        raise
    outcome.rows.update(_publish(spark, staged))
    return outcome
