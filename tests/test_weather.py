"""Observation parsing, daily weather and its cleaning."""

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import parsing as p
from lodestrata.operators.gaps import interpolate_single_gaps
from lodestrata.plans.weather import clean_weather, observations_to_daily


def values(spark, texts, parse):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(parse(F.col("t"))).collect()]


def test_temperature(spark):
    texts = ["+0123,1", "-0050,1", "+9999,9", None, "+9999,1", "12d,1", "nan,1", "", "0x1p3,1"]
    assert values(spark, texts, p.parse_temperature) == [
        12.3, -5.0, None, None, 999.9, None, None, None, None,
    ]
    assert values(spark, ["+9999,1", "+0010,1"], lambda c: p.parse_temperature(c, True)) == [
        None, 1.0,
    ]


def test_precipitation(spark):
    texts = ["01,0050,1,1", "01,0000,1,1", None, "01", "01,xx,1,1", "01,9999,9,9", "06,9989,1,1"]
    assert values(spark, texts, p.parse_precipitation) == [5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 998.9]
    texts = ["01,0050,1,1", "06,0050,1,1"]
    assert values(spark, texts, lambda c: p.parse_precipitation(c, 1)) == [5.0, 0.0]


def test_wind(spark):
    texts = ["090,1,N,0034,1", "090,1", "090,1,N,9999,9", None, "090,1,N,zz,1"]
    assert values(spark, texts, p.parse_wind) == [3.4, None, None, None, None]


def observations(spark, rows, types="DATE string, TMP string"):
    return spark.createDataFrame(rows, types)


def test_daily_rows(spark):
    raw = observations(
        spark,
        [
            ("2024-12-15T06:00:00", "+0020,1"),
            ("2024-12-15T12:00:00", "+0050,1"),
            ("2024-12-15T18:00:00", "+0030,1"),
            ("2024-12-16T06:00:00", "+0010,1"),
            ("no date", "+0990,1"),
        ],
    )
    rows = {str(r.date): r for r in observations_to_daily(raw).collect()}
    assert set(rows) == {"2024-12-15", "2024-12-16"}
    first = rows["2024-12-15"]
    assert (first.observation_count, first.temp_avg_celsius) == (3, 3.3)
    assert (first.temp_min_celsius, first.temp_max_celsius) == (2.0, 5.0)
    # WND and AA1 are absent
    assert first.wind_avg_ms is None and first.precip_total_mm == 0.0


def test_daily_rounding_is_half_even(spark):
    raw = observations(spark, [("2024-12-15T06:00:00", "+0002,1"), ("2024-12-15T07:00:00", "+0003,1")])
    assert observations_to_daily(raw).first().temp_avg_celsius == 0.2


def test_no_temperature_field(spark):
    raw = observations(spark, [("2024-12-15T06:00:00", "090,1,N,0034,1")], "DATE string, WND string")
    row = observations_to_daily(raw).first()
    assert row.temp_avg_celsius is None and row.wind_avg_ms == 3.4


def test_range(daily_weather):
    rows = clean_weather(daily_weather(("2024-12-15", 5.0, 0.0), ("2024-12-16", 100.0, 0.0)), 2024)
    assert rows.count() == 1


def test_nulls_are_tolerated_but_a_null_date_is_not(daily_weather):
    rows = clean_weather(daily_weather(("2024-12-15", None, None), (None, 5.0, 0.0)), 2024).collect()
    assert len(rows) == 1
    assert (rows[0].is_rainy, rows[0].is_snowy) == (False, False)


def test_fahrenheit(daily_weather):
    row = clean_weather(daily_weather(("2024-12-15", 0.0, 0.0)), 2024).first()
    assert row.temp_avg_fahrenheit == 32.0
    assert (row.year, row.month) == (2024, 12)


@pytest.mark.parametrize(
    "average, rain, rainy, snowy",
    [
        (5.0, 12.5, True, False),
        (5.0, 0.0, False, False),
        (5.0, 0.5, False, False),
        (0.0, 5.0, True, True),
        (1.0, 5.0, True, True),
        (10.0, 5.0, True, False),
        (-2.0, 0.0, False, False),
    ],
)
def test_flags(daily_weather, average, rain, rainy, snowy):
    row = clean_weather(daily_weather(("2024-12-15", average, rain)), 2024).first()
    assert (row.is_rainy, row.is_snowy) == (rainy, snowy)


def averages(df):
    return [r.temp_avg_celsius for r in df.orderBy("date").collect()]


def test_one_day_gap(daily_weather):
    df = daily_weather(("2024-12-15", 4.0, 0.0), ("2024-12-16", None, 0.0), ("2024-12-17", 8.0, 0.0))
    assert averages(clean_weather(df, 2024)) == [4.0, 6.0, 8.0]


def test_snow_uses_the_filled_average(daily_weather):
    df = daily_weather(("2024-12-15", 0.0, 0.0), ("2024-12-16", None, 5.0), ("2024-12-17", 1.0, 0.0))
    assert clean_weather(df, 2024).filter("month = 12 AND is_snowy").count() == 1


def test_longer_gaps_and_ends_stay(daily_weather):
    df = daily_weather(
        ("2024-12-14", None, 0.0), ("2024-12-15", 4.0, 0.0), ("2024-12-16", None, 0.0),
        ("2024-12-17", None, 0.0), ("2024-12-18", 8.0, 0.0), ("2024-12-19", None, 0.0),
    )
    assert averages(clean_weather(df, 2024)) == [None, 4.0, None, None, 8.0, None]


def test_gap_at_the_turn_of_the_year_uses_the_neighbour_outside(daily_weather):
    df = daily_weather(("2023-12-31", 2.0, 0.0), ("2024-01-01", None, 0.0), ("2024-01-02", 4.0, 0.0))
    assert averages(clean_weather(df, 2024)) == [3.0, 4.0]


def test_stray_year(daily_weather):
    df = clean_weather(daily_weather(("2024-12-15", 5.0, 0.0), ("2002-07-04", 5.0, 0.0)), 2024)
    assert [str(r.date) for r in df.collect()] == ["2024-12-15"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gaps_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, expected = [], {}
    for station in "abc":
        days = sorted(rng.sample(range(900), rng.choice([1, 2, 40, 300])))
        series = [None if rng.random() < 0.4 else float(rng.randint(0, 99)) for _ in days]
        for i, (day, value) in enumerate(zip(days, series)):
            rows.append((station, day, value))
            if value is None and 0 < i < len(days) - 1:
                before, after = series[i - 1], series[i + 1]
                value = None if before is None or after is None else (before + after) / 2
            expected[station, day] = value
    df = spark.createDataFrame(rows, "station string, n int, value double").withColumn(
        "day", F.date_add(F.lit("2023-01-01").cast("date"), F.col("n"))
    )
    filled = interpolate_single_gaps(df, "value", "day", ["station"])
    assert {(r.station, r.n): r.value for r in filled.collect()} == expected
    plan = interpolate_single_gaps(df, "value", "day")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
