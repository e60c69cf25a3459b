"""Trips: contract, cleaning and the two feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.calendar import (
    add_calendar,
    add_duration,
    add_period,
    add_weekend,
    time_of_day,
)
from lodestrata.functions.measures import avg_where, count_where, round_doubles
from lodestrata.operators.contract import ColumnRule, TableContract, conform, tag
from lodestrata.operators.dedup import dedup
from lodestrata.operators.rules import (
    Rule,
    between,
    in_period,
    later_than,
    not_null,
    valid_rows,
    within,
)

# --- fixed values: raw names, types, bounds and keys ------------------------------

TRIPS = TableContract(
    (
        ColumnRule("vendor_id", "int", ("VendorID",)),
        ColumnRule("pickup_datetime", "timestamp", ("tpep_pickup_datetime",)),
        ColumnRule("dropoff_datetime", "timestamp", ("tpep_dropoff_datetime",)),
        ColumnRule("passenger_count", "int"),
        ColumnRule("trip_distance", "double"),
        ColumnRule("rate_code_id", "int", ("RatecodeID",)),
        ColumnRule("store_and_fwd_flag", "string", required=False),
        ColumnRule("pickup_location_id", "int", ("PULocationID",)),
        ColumnRule("dropoff_location_id", "int", ("DOLocationID",)),
        ColumnRule("payment_type", "int"),
        ColumnRule("fare_amount", "double"),
        ColumnRule("extra", "double"),
        ColumnRule("mta_tax", "double"),
        ColumnRule("tip_amount", "double"),
        ColumnRule("tolls_amount", "double"),
        ColumnRule("improvement_surcharge", "double", required=False),
        ColumnRule("total_amount", "double"),
        ColumnRule("congestion_surcharge", "double", required=False, default=0.0),
        ColumnRule("airport_fee", "double", required=False, default=0.0),
    )
)

TRIP_RULES: tuple[Rule, ...] = (
    not_null("pickup_datetime"),
    not_null("dropoff_datetime"),
    later_than("dropoff_datetime", "pickup_datetime"),
    between("trip_distance", 0, 500),
    between("fare_amount", -10, 10000),
    between("total_amount", -10, 10000),
    between("passenger_count", 0, 9),
    between("pickup_location_id", 1, 263),
    between("dropoff_location_id", 1, 263),
)

TRIP_KEYS = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
    "trip_distance",
)

WEATHER_FEATURES = (
    "temp_avg_celsius",
    "temp_avg_fahrenheit",
    "temp_min_celsius",
    "temp_max_celsius",
    "precip_total_mm",
    "wind_avg_ms",
    "is_rainy",
    "is_snowy",
)


# --- cleaning ------------------------------------------------------------------


def clean_trips(
    raw: DataFrame, year: int, month: int, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Raw trips of one month to cleaned trips."""
    return clean_conformed(conform(raw, TRIPS), year, month, order)


def clean_conformed(
    conformed: DataFrame, year: int, month: int, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Validity, period, de-duplication, derived columns.

    Everything derived depends on the keys only and is added last, so that the
    de-duplication shuffles nothing it could do without.
    """
    kept = valid_rows(conformed, TRIP_RULES).filter(within("pickup_datetime", year, month))
    return derive_trips(dedup(kept, TRIP_KEYS, order))


def derive_trips(trips: DataFrame, taxi_type: str = "yellow") -> DataFrame:
    trips = add_calendar(trips, "pickup_datetime", "pickup")
    trips = add_duration(
        trips, "pickup_datetime", "dropoff_datetime", "trip_duration_minutes"
    )
    return add_period(tag(trips, "taxi_type", taxi_type), "pickup_datetime")


# --- features ------------------------------------------------------------------


def daily_trip_metrics(trips: DataFrame) -> DataFrame:
    """Fourteen measures per pickup date."""
    fare, tip, hour = F.col("fare_amount"), F.col("tip_amount"), F.col("pickup_hour")
    measures = {
        "total_trips": F.count(F.lit(1)),
        "total_passengers": F.sum("passenger_count"),
        "avg_trip_distance": F.avg("trip_distance"),
        "avg_trip_duration_min": F.avg("trip_duration_minutes"),
        "avg_fare": F.avg(fare),
        "avg_tip": F.avg(tip),
        "total_revenue": F.sum("total_amount"),
        "avg_total_amount": F.avg("total_amount"),
        "avg_tip_percentage": avg_where(fare > 0, tip / fare * 100),
        "credit_card_trips": count_where(F.col("payment_type") == 1),
        "cash_trips": count_where(F.col("payment_type") == 2),
        "morning_rush_trips": count_where(hour.between(6, 9)),
        "evening_rush_trips": count_where(hour.between(16, 19)),
        "late_night_trips": count_where((hour >= 22) | (hour <= 5)),
    }
    return _dated(trips, "pickup_date").groupBy("pickup_date").agg(
        *(measure.alias(name) for name, measure in measures.items())
    )


def enrich_with_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on the date.  No broadcast hint: Spark broadcasts the weather
    where its size, known or measured, is under the session's limit."""
    days = _dated(weather, "date").select(F.col("date").alias("pickup_date"), *WEATHER_FEATURES)
    return daily.join(days, "pickup_date", "left")


def trip_weather_daily(
    trips: DataFrame, weather: DataFrame, year: int, month: int
) -> DataFrame:
    """One row per pickup date of the month, with the weather of that date."""
    daily = daily_trip_metrics(in_period(trips, year, month, on="pickup_date"))
    joined = enrich_with_weather(
        add_weekend(daily, "pickup_date"), in_period(weather, year, month, on="date")
    )
    return round_doubles(add_period(joined, "pickup_date"), 2)


def location_hourly_features(trips: DataFrame, year: int, month: int) -> DataFrame:
    """One row per pickup date, hour and zone of the month."""
    inside = _dated(in_period(trips, year, month, on="pickup_date"), "pickup_date")
    hourly = inside.groupBy("pickup_date", "pickup_hour", "pickup_location_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration_min"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("tip_amount").alias("avg_tip"),
        F.sum("total_amount").alias("total_revenue"),
        F.count_distinct("dropoff_location_id").alias("unique_destinations"),
    )
    labelled = add_weekend(hourly, "pickup_date").withColumn(
        "time_of_day", time_of_day(F.col("pickup_hour"))
    )
    return add_period(labelled, "pickup_date")


def _dated(df: DataFrame, column: str) -> DataFrame:
    """The column as a date; tables may hold it as text."""
    if dict(df.dtypes)[column] == "date":
        return df
    return df.withColumn(column, F.col(column).cast("date"))
