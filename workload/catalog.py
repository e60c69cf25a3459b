"""One query per operator, check, suite and job."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import calendar as cal
from lodestrata.functions import parsing
from lodestrata.operators import checks as c
from lodestrata.operators import periods, rules
from lodestrata.operators.contract import conform
from lodestrata.operators.dedup import dedup
from lodestrata.operators.gaps import interpolate_single_gaps
from lodestrata.operators.rules import in_period
from lodestrata.plans import suites, trips, weather
from lodestrata.sources.lake import read_partition, select_features
from workload.surrogate import (
    MONTH,
    YEAR,
    observations_raw,
    order_inventory,
    order_months,
    price_series,
    shifted_orders,
    table,
    trips_raw,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SMALL = suites.SuiteLimits(min_rows=100)
VERDICT = ("check_name", "passed", "metric_value", "threshold", "severity")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs ------------------------------------------------------------------


def _conformed(spark: SparkSession, sf: str) -> DataFrame:
    return conform(trips_raw(spark, sf), trips.TRIPS)


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return trips.clean_trips(trips_raw(spark, sf), YEAR, MONTH)


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return weather.observations_to_daily(observations_raw(spark, sf))


def _silver_weather(spark: SparkSession, sf: str) -> DataFrame:
    return weather.clean_weather(_daily(spark, sf), YEAR)


def _gold(spark: SparkSession, sf: str, silver: DataFrame | None = None) -> DataFrame:
    silver = _silver(spark, sf) if silver is None else silver
    return trips.trip_weather_daily(silver, _silver_weather(spark, sf), YEAR, MONTH)


def _naive(df: DataFrame) -> DataFrame:
    """Zone-less timestamps, which read the same in every client."""
    return df.select(
        *(
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        )
    )


def _verdicts(rows: DataFrame) -> DataFrame:
    return rows.select("layer", "table_name", "year", "month", *VERDICT)


def _check(df: DataFrame, *checks: c.Check, name: str, year: int, month: int) -> DataFrame:
    return _verdicts(c.run_checks({"rows": df}, checks, "silver", name, year, month))


# --- sources, periods -----------------------------------------------------------------


@query
def scan_partition(spark: SparkSession, sf: str) -> DataFrame:
    return read_partition(spark, f"{sf}/orders.parquet", 1998, 6, on="o_orderdate")


@query
def scan_year(spark: SparkSession, sf: str) -> DataFrame:
    return read_partition(spark, f"{sf}/orders.parquet", 1998, on="o_orderdate")


@query
def scan_catalog(spark: SparkSession, sf: str) -> DataFrame:
    order_months(spark, sf).createOrReplaceTempView("orders_by_month")
    return in_period(spark.table("orders_by_month"), 1998, 6)


def _loaded(spark: SparkSession, sf: str) -> DataFrame:
    """Months that saw an order of at least 495000."""
    highest = order_months(spark, sf).groupBy("year", "month").agg(
        F.max("o_totalprice").alias("highest")
    )
    return highest.filter("highest >= 495000").select("year", "month")


@query
def missing_periods(spark: SparkSession, sf: str) -> DataFrame:
    span = table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.add_months(F.max("o_orderdate").cast("date"), 6).alias("last"),
    )
    return periods.missing_periods(periods.month_range(span, "first", "last"), _loaded(spark, sf))


@query
def backfill_periods(spark: SparkSession, sf: str) -> DataFrame:
    return periods.backfill_periods(spark, date(1995, 1, 1), date(2002, 6, 15), _loaded(spark, sf))


@query
def lagged_period(spark: SparkSession, sf: str) -> DataFrame:
    months = order_months(spark, sf).groupBy("year", "month").agg(
        F.max(F.to_date("o_orderdate")).alias("as_of")
    )
    latest = cal.lagged_period(F.col("as_of"), 2)
    return months.select(
        "as_of",
        latest["year"].alias("year"),
        latest["month"].alias("month"),
    )


@query
def trailing_months(spark: SparkSession, sf: str) -> DataFrame:
    months = order_months(spark, sf).select("year", "month").distinct()
    back = F.explode(cal.trailing_months(F.col("year"), F.col("month"), 4)).alias("back")
    return months.select("year", "month", back).select(
        "year",
        "month",
        F.col("back.year").alias("back_year"),
        F.col("back.month").alias("back_month"),
    )


@query
def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    months = order_months(spark, sf).select("year", "month").distinct()
    return months.select(
        "year", "month", F.explode(cal.calendar_days(F.col("year"), F.col("month"))).alias("day")
    )


@query
def period_counts(spark: SparkSession, sf: str) -> DataFrame:
    return periods.period_counts(order_months(spark, sf), c.trend_months(2000, 2))


# --- projections ----------------------------------------------------------------------


@query
def conform_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _naive(_conformed(spark, sf))


@query
def conform_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Every column as text, missing averages as a word."""
    daily = _daily(spark, sf)
    text = {name: F.col(name).cast("string") for name in daily.columns}
    text["temp_avg_celsius"] = F.coalesce(text["temp_avg_celsius"], F.lit("none"))
    return conform(daily.select(*(v.alias(n) for n, v in text.items())), weather.WEATHER)


@query
def trip_calendar(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts")
    return cal.add_period(cal.add_calendar(events, "ts", "pickup"), "ts").drop("ts")


@query
def trip_duration(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.expr("ts + make_dt_interval(0, 0, 0, CAST(event_id % 7919 AS DECIMAL(18, 6)) + 0.75)")
        .alias("until"),
    )
    return cal.add_duration(events, "ts", "until", "minutes").select("event_id", "minutes")


@query
def weather_derived(spark: SparkSession, sf: str) -> DataFrame:
    return weather.derive_weather(_daily(spark, sf))


@query
def weekend_flags(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return cal.add_weekend(orders, "o_orderdate")


@query
def time_of_day(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", cal.time_of_day(F.hour("ts")).alias("time_of_day")
    )


# --- observation fields -----------------------------------------------------------------


@query
def parse_temperature(spark: SparkSession, sf: str) -> DataFrame:
    return observations_raw(spark, sf).select(
        "event_id",
        parsing.parse_temperature(F.col("TMP")).alias("celsius"),
        parsing.parse_temperature(F.col("TMP"), strict_sentinel=True).alias("celsius_strict"),
    )


@query
def parse_precipitation(spark: SparkSession, sf: str) -> DataFrame:
    return observations_raw(spark, sf).select(
        "event_id", parsing.parse_precipitation(F.col("AA1")).alias("millimetres")
    )


@query
def parse_wind(spark: SparkSession, sf: str) -> DataFrame:
    return observations_raw(spark, sf).select(
        "event_id", parsing.parse_wind(F.col("WND")).alias("metres_per_second")
    )


@query
def daily_weather(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf)


@query
def missing_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rows of observations that have no temperature, wind and rain fields."""
    return weather.observations_to_daily(observations_raw(spark, sf).select("DATE"))


# --- filters, de-duplication, gaps --------------------------------------------------------


@query
def valid_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _naive(rules.valid_rows(_conformed(spark, sf), trips.TRIP_RULES))


@query
def rejected_trips(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = rules.split_valid(_conformed(spark, sf), trips.TRIP_RULES)
    return _naive(rejected).select(
        "pickup_datetime",
        "pickup_location_id",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


@query
def period_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _naive(in_period(_conformed(spark, sf), YEAR, MONTH, on="pickup_datetime"))


@query
def valid_weather(spark: SparkSession, sf: str) -> DataFrame:
    checked = rules.valid_rows(conform(_daily(spark, sf), weather.WEATHER), weather.WEATHER_RULES)
    return in_period(checked, YEAR, on="date")


@query
def cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    return rules.cleaning_report(
        _conformed(spark, sf),
        trips.TRIP_RULES,
        "pickup_datetime",
        YEAR,
        MONTH,
        trips.TRIP_KEYS,
    )


@query
def dedup_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _naive(dedup(_conformed(spark, sf), trips.TRIP_KEYS))


@query
def dedup_first_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Earliest trip per vendor, passenger count and pickup zone."""
    keys = ("vendor_id", "passenger_count", "pickup_location_id")
    return _naive(
        dedup(
            _conformed(spark, sf),
            keys,
            order=("pickup_datetime", "dropoff_datetime", "fare_amount"),
        )
    )


@query
def fill_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return interpolate_single_gaps(price_series(spark, sf), "price", "day", ["o_orderstatus"])


@query
def clean_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _naive(_silver(spark, sf))


@query
def clean_weather(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_weather(spark, sf)


# --- features ---------------------------------------------------------------------------


@query
def daily_trip_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return trips.daily_trip_metrics(_silver(spark, sf))


@query
def trip_weather_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf)


@query
def location_hourly_features(spark: SparkSession, sf: str) -> DataFrame:
    return trips.location_hourly_features(_silver(spark, sf), YEAR, MONTH)


@query
def feature_query(spark: SparkSession, sf: str) -> DataFrame:
    return select_features(
        _gold(spark, sf),
        YEAR,
        MONTH,
        ("pickup_date", "total_trips", "avg_tip_percentage", "temp_avg_fahrenheit", "is_rainy"),
        where="is_rainy = true",
    )


# --- checks -----------------------------------------------------------------------------


@query
def row_count_floor(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_period(order_months(spark, sf), 1998, 6)
    low = _check(rows, c.row_count_floor(50), name="orders", year=1998, month=6)
    high = _check(rows, c.row_count_floor(), name="orders", year=1998, month=6)
    return low.unionByName(high)


@query
def row_count_trend(spark: SparkSession, sf: str) -> DataFrame:
    """A usual month, the last one, cut off after a day, and one without history."""
    orders = order_months(spark, sf)
    runs = [
        _verdicts(
            c.run_checks(
                {"history": c.trend_history(orders, y, m)},
                [c.row_count_trend(y, m)],
                "silver",
                "orders",
                y,
                m,
            )
        )
        for y, m in ((2000, 6), (2001, 8), (1995, 2))
    ]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query
def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_period(_conformed(spark, sf), YEAR, MONTH, on="pickup_datetime")
    columns = ("pickup_datetime", "pickup_location_id", "fare_amount")
    return _check(
        rows,
        c.null_rates(columns),
        c.null_rates((*columns, "passenger_count", "rate_code_id"), 0.02),
        name="trips",
        year=YEAR,
        month=MONTH,
    )


@query
def value_ranges(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    ranges = (
        c.Range("l_quantity", 1, 50),
        c.Range("l_discount", 0, 0.1),
        c.Range("l_extendedprice", 0, 1_000_000, low_inclusive=False, high_inclusive=False),
    )
    tight = (c.Range("l_quantity", 1, 50, low_inclusive=False), c.Range("l_tax", 0, 0.08))
    twice = (c.Range("l_quantity", 10, 40), c.Range("l_quantity", 0, 100))
    passing = _check(lines, c.value_ranges(ranges), name="lineitem", year=1998, month=1)
    failing = _check(lines, c.value_ranges(tight), name="lineitem", year=1998, month=1)
    # Two rules on one column, of which the first is broken.
    both = _check(lines, c.value_ranges(twice), name="lineitem", year=1998, month=1)
    return passing.unionByName(failing).unionByName(both)


@query
def stat_bounds(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return _check(
        lines,
        c.stat_bounds("avg(l_quantity)", 20, 30, "quantity"),
        c.stat_bounds("max(l_discount)", 0.2, 0.5, "discount"),
        name="lineitem",
        year=1998,
        month=1,
    )


@query
def calendar_completeness(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return _check(
        events, c.calendar_completeness("ts", YEAR, MONTH), name="events", year=YEAR, month=MONTH
    )


@query
def dates_in_partition(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_period(shifted_orders(spark, sf), 1998, 6)
    check = c.dates_in_partition("o_orderdate", 1998, 6)
    return _check(rows, check, name="orders", year=1998, month=6)


@query
def unexpected_partitions(spark: SparkSession, sf: str) -> DataFrame:
    dated = trips_raw(spark, sf).select(F.year("tpep_pickup_datetime").alias("year"))
    checks = [c.unexpected_partitions([YEAR]), c.unexpected_partitions([YEAR - 22, YEAR])]
    runs = [
        _verdicts(c.run_checks({"partitions": dated}, [check], "bronze", "trips", YEAR, MONTH))
        for check in checks
    ]
    return runs[0].unionByName(runs[1])


@query
def cross_layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """As it should be, with more wanted than is kept, and with the layers swapped."""
    raw = trips_raw(spark, sf)
    tables = {"bronze": raw, "silver": trips.clean_trips(raw, YEAR, MONTH)}
    swapped = {"bronze": tables["silver"], "silver": raw}
    runs = [
        _verdicts(c.run_checks(layers, [check], "silver", "trips", YEAR, MONTH))
        for layers, check in (
            (tables, c.cross_layer_counts()),
            (tables, c.cross_layer_counts(0.99)),
            (swapped, c.cross_layer_counts()),
        )
    ]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query
def gold_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Features of all trips, and of the trips of one vendor only."""
    silver = _silver(spark, sf)
    runs = [
        _verdicts(
            c.run_checks(
                {"gold": trips.daily_trip_metrics(rows), "silver": silver},
                [c.gold_reconciliation()], "gold", "daily", YEAR, MONTH,
            )
        )
        for rows in (silver, silver.filter("vendor_id = 1"))
    ]
    return runs[0].unionByName(runs[1])


# --- files ------------------------------------------------------------------------------

FULL, EMPTY = (1998, 6), (2010, 1)  # a month with orders, and one without


def _file_rows(spark: SparkSession, sf: str, *runs) -> DataFrame:
    """Check rows of (month, check) over the inventory of the orders."""
    files = order_inventory(spark, sf)
    out = None
    for (y, m), check in runs:
        tables = {"files": in_period(files, y, m)}
        rows = _verdicts(c.run_checks(tables, [check], "bronze", "orders", y, m))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def files_exist(spark: SparkSession, sf: str) -> DataFrame:
    return _file_rows(spark, sf, (FULL, c.files_exist()), (EMPTY, c.files_exist()))


@query
def total_bytes(spark: SparkSession, sf: str) -> DataFrame:
    few, many = c.total_bytes(1), c.total_bytes(10**12)
    return _file_rows(spark, sf, (FULL, few), (FULL, many), (EMPTY, few))


@query
def file_count(spark: SparkSession, sf: str) -> DataFrame:
    """Within the ceiling, above it, above it but with enough bytes a file, and none."""
    return _file_rows(
        spark, sf,
        (FULL, c.file_count(1, 10**6)),
        (FULL, c.file_count(1, 1)),
        (FULL, c.file_count(1, 1, bytes_per_file=10)),
        (FULL, c.file_count(1, 1, bytes_per_file=10**9)),
        (EMPTY, c.file_count(1, 5)),
    )


@query
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("1998-07-02 06:00:00").cast("timestamp")
    return _file_rows(
        spark, sf,
        (FULL, c.freshness(24 * 31, now)),
        (FULL, c.freshness(1, now)),
        (EMPTY, c.freshness(48, now)),
    )


def _bronze(spark: SparkSession, sf: str, table_name: str, month: int | None) -> DataFrame:
    """The bronze suite of a period with files, with too tight limits, and without files."""
    files = order_inventory(spark, sf)
    wide, tight = suites.FileLimits(1, 10**6), suites.FileLimits(10**12, 1, 10**9)
    out = None
    for (y, _), limits in ((FULL, wide), (FULL, tight), (EMPTY, wide)):
        rows = _verdicts(suites.file_checks(files, limits, "bronze", table_name, y, month))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def suite_bronze_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf, suites.TRIP_TABLE, 6)


@query
def suite_bronze_weather(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf, suites.WEATHER_TABLE, None)


@query
def gate(spark: SparkSession, sf: str) -> DataFrame:
    """Row checks run where the files are there, and not where they are missing."""
    files, orders = order_inventory(spark, sf), order_months(spark, sf)
    rows = []
    for y, m in (FULL, EMPTY):
        first = suites.file_checks(files, suites.FileLimits(1), "bronze", "orders", y, m)
        inside = in_period(orders, y, m)
        rows += suites.gated(
            first,
            lambda: c.run_checks({"rows": inside}, [c.row_count_floor(50)], "silver", "orders", y, m),
        )
    return _verdicts(spark.createDataFrame(rows, c.CHECK_SCHEMA))


@query
def suite_silver_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _verdicts(suites.silver_trip_checks(_silver(spark, sf), YEAR, MONTH, SMALL))


@query
def suite_silver_weather(spark: SparkSession, sf: str) -> DataFrame:
    return _verdicts(suites.silver_weather_checks(_silver_weather(spark, sf), YEAR, MONTH))


@query
def suite_gold(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf)
    gold = _gold(spark, sf, silver)
    rows = _verdicts(suites.gold_checks(gold, silver, YEAR, MONTH, SMALL))
    # The mean of rounded means depends on the order of the days in its last bits.
    return rows.withColumn("metric_value", F.round("metric_value", 9))


@query
def evaluate_checks(spark: SparkSession, sf: str) -> DataFrame:
    rows = suite_silver_trips(spark, sf).unionByName(suite_silver_weather(spark, sf))
    return c.evaluate_checks(rows)
