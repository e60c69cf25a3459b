"""Weather: hourly observations to daily rows, and their cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.calendar import add_period
from lodestrata.functions.parsing import (
    parse_observed_at,
    parse_precipitation,
    parse_temperature,
    parse_wind,
)
from lodestrata.functions.weather import is_rainy, is_snowy, to_fahrenheit
from lodestrata.operators.contract import ColumnRule, TableContract, conform
from lodestrata.operators.gaps import interpolate_single_gaps
from lodestrata.operators.rules import Rule, at_least, between, not_null, valid_rows, within

# --- fixed values: names, types and bounds ------------------------------------------

WEATHER = TableContract(
    (
        ColumnRule("date", "date"),
        ColumnRule("temp_avg_celsius", "double"),
        ColumnRule("temp_min_celsius", "double"),
        ColumnRule("temp_max_celsius", "double"),
        ColumnRule("precip_total_mm", "double"),
        ColumnRule("wind_avg_ms", "double"),
    )
)

WEATHER_RULES: tuple[Rule, ...] = (
    not_null("date"),
    between("temp_avg_celsius", -40, 50, allow_null=True),
    at_least("precip_total_mm", 0, allow_null=True),
    between("wind_avg_ms", 0, 50, allow_null=True),
)


def parse_observations(
    raw: DataFrame, strict_sentinel: bool = False, period_hours: int | None = None
) -> DataFrame:
    """Typed hourly observations.  Absent fields: temperature and wind are null,
    precipitation is 0.0."""
    present = {name.lower() for name in raw.columns}

    def field(name: str, parsed: Column, otherwise: float | None) -> Column:
        return parsed if name.lower() in present else F.lit(otherwise).cast("double")

    temperature = field("TMP", parse_temperature(F.col("TMP"), strict_sentinel), None)
    wind = field("WND", parse_wind(F.col("WND")), None)
    precipitation = field("AA1", parse_precipitation(F.col("AA1"), period_hours), 0.0)
    return raw.select(
        parse_observed_at(F.col("DATE")).alias("observed_at"),
        temperature.alias("temp_celsius"),
        wind.alias("wind_speed_ms"),
        precipitation.alias("precip_mm"),
    )


def observations_to_daily(
    raw: DataFrame, strict_sentinel: bool = False, period_hours: int | None = None
) -> DataFrame:
    """Daily weather; rows without a readable time drop out.  Rounding is
    half-even, to one place."""
    hourly = parse_observations(raw, strict_sentinel, period_hours)
    dated = hourly.select("*", F.to_date("observed_at").alias("date")).filter("date IS NOT NULL")
    return dated.groupBy("date").agg(
        F.bround(F.avg("temp_celsius"), 1).alias("temp_avg_celsius"),
        F.bround(F.min("temp_celsius"), 1).alias("temp_min_celsius"),
        F.bround(F.max("temp_celsius"), 1).alias("temp_max_celsius"),
        F.bround(F.sum("precip_mm"), 1).alias("precip_total_mm"),
        F.bround(F.avg("wind_speed_ms"), 1).alias("wind_avg_ms"),
        F.count("observed_at").alias("observation_count"),
    )


def derive_weather(daily: DataFrame) -> DataFrame:
    average, rain = F.col("temp_avg_celsius"), F.col("precip_total_mm")
    derived = daily.withColumns(
        {
            "temp_avg_fahrenheit": to_fahrenheit(average),
            "temp_min_fahrenheit": to_fahrenheit(F.col("temp_min_celsius")),
            "temp_max_fahrenheit": to_fahrenheit(F.col("temp_max_celsius")),
            "is_rainy": is_rainy(rain),
            "is_snowy": is_snowy(rain, average),
        }
    )
    return add_period(derived, "date")


def clean_weather(
    daily: DataFrame, year: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Daily weather of one year, validated and gap-filled.  The year is cut out
    after the filling, whose neighbours may lie outside.  ``partition_by`` names
    the station column of a table of several stations."""
    checked = valid_rows(conform(daily, WEATHER), WEATHER_RULES)
    filled = interpolate_single_gaps(checked, "temp_avg_celsius", "date", partition_by)
    return derive_weather(filled).filter(within("date", year))
