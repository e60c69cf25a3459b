"""Readers, writers, landing and the monthly run, on files."""

import datetime as dt
import os
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.contract import conform
from lodestrata.plans import suites
from lodestrata.plans.monthly import QualityError, exact_report, run_month, silver_trips
from lodestrata.plans.trips import TRIPS
from lodestrata.session import shuffles_sized_for
from lodestrata.sources.commit import discard
from lodestrata.sources.inventory import file_inventory, list_files
from lodestrata.sources.lake import (
    Lake,
    _written,
    land_periods,
    overwrite_partitions,
    publish_period,
    read_features,
    read_observations,
    read_partition,
    register_external,
    stage_period,
    write_partitions,
)

_names = iter(range(1000))


def fresh_name():
    return f"t{next(_names)}"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "v int, year int, month int")


def stored(spark, table, *columns):
    columns = columns or ("v", "year", "month")
    return sorted(tuple(r) for r in spark.table(table).select(*columns).collect())


def test_paths():
    lake = Lake("s3a://bucket/lake/", {"silver": "clean"})
    assert lake.path("bronze", "a", "b", 2024, 3) == "s3a://bucket/lake/bronze/a/b/year=2024/month=3/"
    assert lake.path("gold", "a", "b") == "s3a://bucket/lake/gold/a/b/"
    assert lake.table("silver", "t") == "clean.t" and lake.table("gold", "t") == "gold.t"


def test_rewriting_a_month_leaves_the_others(spark, scratch):
    t = fresh_name()
    n = overwrite_partitions(frame(spark, (1, 2024, 1), (2, 2024, 2)), t, scratch + "/t")
    assert n == 2
    assert overwrite_partitions(frame(spark, (9, 2024, 2), (8, 2024, 2)), t, scratch + "/t") == 2
    assert stored(spark, t) == [(1, 2024, 1), (8, 2024, 2), (9, 2024, 2)]
    assert os.path.isdir(scratch + "/t/year=2024/month=2")


def test_columns_in_another_order_and_new_ones(spark, scratch):
    t = fresh_name()
    overwrite_partitions(frame(spark, (1, 2024, 1)), t, scratch + "/t")
    more = spark.createDataFrame([(2024, 2, 2.5, 7)], "year int, month int, w double, v int")
    overwrite_partitions(more, t, scratch + "/t")
    assert stored(spark, t, "v", "w", "month") == [(1, None, 1), (7, 2.5, 2)]
    overwrite_partitions(frame(spark, (3, 2024, 3)), t, scratch + "/t")
    assert (3, None, 3) in stored(spark, t, "v", "w", "month")


def test_a_run_without_rows_empties_its_month(spark, scratch):
    t = fresh_name()
    overwrite_partitions(frame(spark, (1, 2024, 1), (2, 2024, 2)), t, scratch + "/t")
    nothing = frame(spark, (5, 2024, 2)).filter("v > 5")
    scope = {"year": 2024, "month": 2}
    assert overwrite_partitions(nothing, t, scratch + "/t", scope=scope) == 0
    assert stored(spark, t) == [(1, 2024, 1)]
    assert list_files(spark, scratch + "/t").filter("month = 2").count() == 0


def test_scope_of_a_year_drops_months_not_written(spark, scratch):
    t = fresh_name()
    overwrite_partitions(
        frame(spark, (0, 2023, 5), (1, 2024, 1), (2, 2024, 2)), t, scratch + "/t"
    )
    overwrite_partitions(frame(spark, (3, 2024, 2)), t, scratch + "/t", scope={"year": 2024})
    assert stored(spark, t) == [(0, 2023, 5), (3, 2024, 2)]


def test_a_run_found_empty_while_running(spark, scratch):
    """The join is known to be empty only once its sides have run."""
    t = fresh_name()
    overwrite_partitions(frame(spark, (1, 2024, 1), (2, 2024, 2)), t, scratch + "/t")
    base = frame(spark, (5, 2024, 2)).repartition(3)
    other = spark.range(10).repartition(3).groupBy((F.col("id") + 100).cast("int").alias("v")).count()
    nothing = base.join(other.hint("merge"), "v").drop("count")
    scope = {"year": 2024, "month": 2}
    assert overwrite_partitions(nothing, t, scratch + "/t", scope=scope) == 0
    assert stored(spark, t) == [(1, 2024, 1)]


def test_lost_observation(spark):
    df = frame(spark, (1, 2024, 1), (2, 2024, 2), (3, 2024, 2))
    assert _written({}, df, ("year", "month")) == (3, {(2024, 1), (2024, 2)})


def test_a_new_table_over_an_old_path(spark, scratch):
    """A catalog that starts empty finds the months already there."""
    frame(spark, (1, 2024, 1), (2, 2024, 2), (3, 2024, 3)).write.partitionBy("year", "month").parquet(
        scratch + "/t"
    )
    t = fresh_name()
    scope = {"year": 2024, "month": 2}
    overwrite_partitions(frame(spark, (9, 2024, 2)), t, scratch + "/t", scope=scope)
    assert stored(spark, t) == [(1, 2024, 1), (3, 2024, 3), (9, 2024, 2)]
    t = fresh_name()
    nothing = frame(spark, (9, 2024, 2)).filter("v > 9")
    overwrite_partitions(nothing, t, scratch + "/t", scope=scope)
    assert stored(spark, t) == [(1, 2024, 1), (3, 2024, 3)]


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with shuffles_sized_for(spark, 10**12):
        assert int(spark.conf.get(key)) > 10_000
    with shuffles_sized_for(spark, 10):
        assert spark.conf.get(key) == before
    assert spark.conf.get(key) == before


def test_the_session_mode_is_left_alone(spark, scratch):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    try:
        t = fresh_name()
        overwrite_partitions(frame(spark, (1, 2024, 1)), t, scratch + "/t")
        overwrite_partitions(frame(spark, (2, 2024, 2)), t, scratch + "/t")
        write_partitions(frame(spark, (1, 2024, 1)), scratch + "/p", ["year"])
        write_partitions(frame(spark, (2, 2025, 1)), scratch + "/p", ["year"])
        assert len(stored(spark, t)) == 2
        assert spark.read.parquet(scratch + "/p").count() == 2
        assert spark.conf.get(key).lower() == "static"
    finally:
        spark.conf.set(key, "dynamic")


def test_read_partition_prunes(spark, scratch):
    frame(spark, (1, 2024, 1), (2, 2024, 2)).write.partitionBy("year", "month").parquet(scratch + "/p")
    df = read_partition(spark, scratch + "/p", 2024, 2)
    assert [r.v for r in df.collect()] == [2]
    assert "PartitionFilters: [isnotnull(year" in df._jdf.queryExecution().toString()
    assert read_partition(spark, scratch + "/p", 2024).count() == 2
    with pytest.raises(ValueError):
        read_partition(spark, scratch + "/p/year=2024/month=2", 2024, 2)


def test_read_features(spark, scratch):
    t = fresh_name()
    rows = [(dt.date(2024, 12, d), d % 2 == 0, d, 2024, 12) for d in (3, 1, 2)]
    df = spark.createDataFrame(
        rows + [(dt.date(2024, 11, 2), True, 9, 2024, 11)],
        "pickup_date date, is_rainy boolean, total_trips int, year int, month int",
    )
    overwrite_partitions(df, t, scratch + "/t")
    got = read_features(spark, t, 2024, 12, ("pickup_date", "total_trips"))
    assert [r.total_trips for r in got.collect()] == [1, 2, 3]
    assert read_features(spark, t, 2024, 12, where="is_rainy = true").count() == 1


def test_inventory(spark, scratch):
    assert file_inventory(spark, scratch + "/absent").count() == 0
    frame(spark, (1, 2024, 1), (2, 2024, 2)).coalesce(1).write.partitionBy("year", "month").parquet(
        scratch + "/p"
    )
    got = {(r.year, r.month): r for r in file_inventory(spark, scratch + "/p").collect()}
    assert set(got) == {(2024, 1), (2024, 2)}
    one = got[2024, 1]
    folder = scratch + "/p/year=2024/month=1"
    size = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet"))
    assert (one.files, one.bytes) == (1, size)


def test_inventory_reads_padded_months_as_numbers(spark, scratch):
    spark.range(1).write.parquet(scratch + "/p/year=2024/month=03")
    spark.range(1).write.parquet(scratch + "/p/year=2024/month=11")
    got = file_inventory(spark, scratch + "/p").collect()
    assert {(r.year, r.month) for r in got} == {(2024, 3), (2024, 11)}


def test_landing_files(spark, scratch):
    """Files, as they arrive: one Parquet file per month."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    source, target = scratch + "/landing", scratch + "/bronze"
    os.mkdir(source)
    pq.write_table(pa.table({"id": [1, 2, 3]}), source + "/green_tripdata_2024-01.parquet")
    pq.write_table(
        pa.table({"id": [1.5, 2.5], "extra": [1, 2]}), source + "/green_tripdata_2024-02.parquet"
    )
    pq.write_table(pa.table({"id": [7]}), source + "/yellow_tripdata_2024-02.parquet")

    def land(months, skip=True):
        outcomes = land_periods(
            spark, source, target, months, skip, "green_*_{year}-{month:02d}.parquet"
        )
        return [(o["month"], o["success"], o["skipped"]) for o in outcomes]

    assert land([(2024, 1)]) == [(1, True, False)]
    assert land([(2024, 1), (2024, 2), (2024, 3)]) == [
        (1, True, True), (2, True, False), (3, False, False),
    ]
    assert land([(2024, 1)], skip=False) == [(1, True, False)]
    assert spark.read.parquet(target + "/year=2024/month=1").count() == 3
    assert spark.read.parquet(target + "/year=2024/month=2").columns == ["id", "extra"]


def test_observations_csv(spark, scratch):
    with open(scratch + "/o.csv", "w") as f:
        f.write('"STATION","DATE","TMP","REM"\n')
        f.write('"1","2024-12-15T06:00:00","+0123,1","he said ""no"", twice"\n')
        f.write('"1","2024-12-15T07:00:00",,""\n')
    df = read_observations(spark, scratch + "/o.csv")
    assert {t for _, t in df.dtypes} == {"string"}
    rows = df.collect()
    assert rows[0].TMP == "+0123,1" and rows[0].REM == 'he said "no", twice'
    assert rows[1].TMP is None


def test_register_external(spark, scratch):
    t = fresh_name()
    spark.range(2).write.parquet(scratch + "/r/year=2024/month=1")
    register_external(spark, t, scratch + "/r")
    assert spark.table(t).filter("year = 2024 and month = 1").count() == 2
    spark.range(3).selectExpr("id", "1.5D as fee").write.parquet(scratch + "/r/year=2024/month=2")
    register_external(spark, t, scratch + "/r")
    assert spark.table(t).count() == 5
    assert spark.table(t).filter("fee = 1.5").count() == 3
    assert spark.table(t).filter("month = 1 and fee is null").count() == 2


# --- the monthly run -----------------------------------------------------------------

SMALL = suites.SuiteLimits(
    bronze_trips=suites.FileLimits(100, 5),
    silver_trips=suites.FileLimits(100, 200),
    min_rows=10,
    expected_years=(2023, 2024),
)


@pytest.fixture
def landing(spark, scratch):
    """Three months of trips and two years of observations, as files."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.mkdir(scratch + "/landing")

    def month(year, number, days, fee_name="Airport_fee"):
        rows = []
        for day in range(1, days + 1):
            for i in range(12):
                start = dt.datetime(year, number, day, (i * 2) % 24, i)
                rows.append((1 + i % 2, start, start + dt.timedelta(minutes=10 + i), 1.0 + i % 3,
                             1.0 + i, 1.0, "N", 100 + i, 200 - i, 1 + i % 2, 10.0 + i, 0.5, 0.5,
                             2.0, 0.0, 1.0, 13.0 + i, 2.5, 1.25))
        stray = list(rows[0])
        stray[1], stray[2] = dt.datetime(2002, 7, 4), dt.datetime(2002, 7, 4, 1)
        bad = list(rows[0])
        bad[4] = -1.0
        rows += [rows[1], tuple(stray), tuple(bad)]
        names = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                 "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID",
                 "DOLocationID", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount",
                 "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
                 fee_name]
        columns = {n: [r[i] for r in rows] for i, n in enumerate(names)}
        pq.write_table(
            pa.table(columns), f"{scratch}/landing/yellow_tripdata_{year}-{number:02d}.parquet"
        )

    def weather(year, skip=()):
        path = f"{scratch}/landing/{year}.csv"
        day = dt.date(year, 1, 1)
        with open(path, "w") as f:
            f.write('"STATION","DATE","TMP","WND","AA1"\n')
            while day.year == year:
                if day not in skip:
                    for hour in (0, 6, 12, 18):
                        f.write(f'"1","{day}T{hour:02d}:51:00","+{day.month * 10:04d},1",'
                                f'"090,1,N,0034,1","01,0010,1,1"\n')
                day += dt.timedelta(days=1)
        return path

    return scratch, month, weather


def lake_of(spark, root):
    mark = fresh_name()
    return Lake(root + "/lake", {k: f"{mark}_{k}" for k in ("bronze", "silver", "gold")})


def _green_file(root):
    """One month of green trips, as a copy to make."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    made = root + "/green.parquet"
    pq.write_table(pa.table({"lpep_pickup_datetime": [dt.datetime(2024, 1, 1)]}), made)
    return made, root + "/landing/green_tripdata_2024-01.parquet"


def test_monthly_run(spark, landing):
    root, month, weather = landing
    lake = lake_of(spark, root)
    csv = weather(2024)
    shutil.copy(*_green_file(root))
    for m, days in ((1, 31), (2, 29)):
        month(2024, m, days)
        out = run_month(spark, lake, 2024, m, root + "/landing", csv, SMALL)
        kept = days * 12
        report = out.cleaning
        assert (report.rows_in, report.invalid, report.out_of_period, report.duplicates,
                report.rows_out) == (kept + 3, 1, 1, 1, kept)
        assert out.rows == {
            "yellow_taxi_trips": kept,
            "nyc_weather_daily": 366,
            "trip_weather_daily": days,
            "location_hourly_features": days * 12,
        }
        assert [name for name in out.checks] == [
            "bronze_trips", "bronze_weather", "silver_trips", "silver_weather", "gold",
        ]
        assert all(r.passed for rows in out.checks.values() for r in rows)
        assert out.landed["green"]["success"] is (m == 1)
    gold = spark.table(lake.table("gold", "trip_weather_daily"))
    assert gold.count() == 31 + 29
    first = gold.filter("pickup_date = date'2024-02-01'").first()
    assert (first.total_trips, first.temp_avg_celsius, first.is_rainy) == (12, 2.0, True)
    silver = spark.table(lake.table("silver", "yellow_taxi_trips"))
    # the capitalised fee column keeps its values
    assert silver.select("airport_fee").distinct().collect()[0][0] == 1.25
    hourly = spark.table(lake.table("gold", "location_hourly_features"))
    assert hourly.agg(F.sum("trip_count")).first()[0] == silver.count()
    assert gold.agg(F.sum("total_trips")).first()[0] == silver.count()
    # again: landing is skipped, tables do not grow
    history = fresh_name()
    again = run_month(
        spark, lake, 2024, 2, root + "/landing", csv, SMALL, history_table=history
    )
    assert again.landed["yellow"]["skipped"] and not again.landed["green"]["success"]
    recorded = spark.table(history)
    assert recorded.count() == sum(len(rows) for rows in again.checks.values())
    assert {(r.layer, r.month) for r in recorded.select("layer", "month").distinct().collect()} >= {
        ("silver", 2), ("gold", 2), ("bronze", None),
    }
    assert spark.table(lake.table("gold", "trip_weather_daily")).count() == 31 + 29


def test_report_counted_again(spark, landing):
    """The exact count, used when observed counts are off, gives the same."""
    root, month, weather = landing
    lake = lake_of(spark, root)
    month(2024, 1, 31)
    out = run_month(spark, lake, 2024, 1, root + "/landing", weather(2024), SMALL)
    raw = spark.read.parquet(lake.path("bronze", *suites.TRIP_SOURCE, 2024, 1))
    assert exact_report(conform(raw, TRIPS), 2024, 1) == out.cleaning


def test_padded_raw_months_are_found(spark, landing):
    root, month, _ = landing
    lake = lake_of(spark, root)
    lake.create_layers(spark)
    month(2024, 1, 31)
    raw = spark.read.parquet(root + "/landing/yellow_tripdata_2024-01.parquet")
    raw.write.parquet(lake.path("bronze", *suites.TRIP_SOURCE) + "year=2024/month=01")
    assert silver_trips(spark, lake, 2024, 1).rows_out == 31 * 12


def test_a_failed_suite_stops_the_run(spark, landing):
    root, month, weather = landing
    lake = lake_of(spark, root)
    month(2024, 3, 31)
    with pytest.raises(QualityError, match="bronze_trips"):
        run_month(spark, lake, 2024, 3, root + "/landing", weather(2024))
    assert not spark.catalog.tableExists(lake.table("silver", "yellow_taxi_trips"))


def test_a_missing_weather_day_stops_before_gold(spark, landing):
    root, month, weather = landing
    lake = lake_of(spark, root)
    month(2023, 5, 31)
    csv = weather(2023, skip={dt.date(2023, 5, 7)})
    with pytest.raises(QualityError, match="silver_weather.*2023-05-07"):
        run_month(spark, lake, 2023, 5, root + "/landing", csv, SMALL)
    assert not spark.catalog.tableExists(lake.table("gold", "trip_weather_daily"))


def whole(spark, table):
    return sorted(map(str, spark.table(table).collect()))


def left_behind(root):
    return [d for d, _, files in os.walk(root) if "/_landing/" in d and files]


@pytest.mark.parametrize(
    "limits, suite, tables",
    [
        ({"min_rows": 10**6}, "silver_trips", ("silver.yellow_taxi_trips", "silver.nyc_weather_daily")),
        ({"silver_weather": suites.FileLimits(10**9, 50)}, "silver_weather", ("silver.yellow_taxi_trips",)),
        ({"gold": suites.FileLimits(10**9)}, "gold", ("gold.trip_weather_daily", "gold.location_hourly_features")),
    ],
)
def test_a_failing_month_keeps_its_old_rows(spark, landing, limits, suite, tables):
    root, month, weather = landing
    lake = lake_of(spark, root)
    month(2024, 1, 31)
    csv = weather(2024)
    run_month(spark, lake, 2024, 1, root + "/landing", csv, SMALL)
    names = [lake.table(*t.split(".")) for t in tables]
    before = [whole(spark, n) for n in names]
    month(2024, 1, 30)  # a day less
    with pytest.raises(QualityError, match=suite):
        run_month(spark, lake, 2024, 1, root + "/landing", csv, replace(SMALL, **limits), skip_existing=False)
    assert [whole(spark, n) for n in names] == before
    assert not left_behind(root)
    month(2024, 1, 31)
    out = run_month(spark, lake, 2024, 1, root + "/landing", csv, SMALL, skip_existing=False)
    assert out.rows["yellow_taxi_trips"] == 31 * 12 and [whole(spark, n) for n in names] == before


def test_a_staged_period(spark, scratch):
    t, path = fresh_name(), scratch + "/t"
    first = stage_period(frame(spark, (1, 2024, 1)), t, path, {"year": 2024, "month": 1})
    assert not spark.catalog.tableExists(t) and first.rows == 1
    assert [tuple(r) for r in first.frame(spark).collect()] == [(1, 2024, 1)]
    assert publish_period(spark, first) == 1 and stored(spark, t) == [(1, 2024, 1)]
    wide = frame(spark, (2, 2024, 2), (3, 2024, 2)).withColumn("extra", F.lit("x"))
    publish_period(spark, stage_period(wide, t, path, {"year": 2024, "month": 2}))
    again = stage_period(frame(spark, (7, 2024, 1)), t, path, {"year": 2024, "month": 1})
    assert stored(spark, t) == [(1, 2024, 1), (2, 2024, 2), (3, 2024, 2)]
    assert sorted(r.v for r in again.frame(spark).collect()) == [2, 3, 7]
    discard(spark, again.staged)
    assert [tuple(r) for r in spark.table(t).select("v", "extra").orderBy("v").collect()] == [(1, None), (2, "x"), (3, "x")]
    year = stage_period(frame(spark, (4, 2024, 2), (5, 2024, 12)), t, path, {"year": 2024})
    assert year.rows == 2 and publish_period(spark, year) == 2
    assert stored(spark, t) == [(4, 2024, 2), (5, 2024, 12)]
    nothing = stage_period(frame(spark, (9, 2024, 2)).filter("v > 9"), t, path, {"year": 2024, "month": 2})
    assert publish_period(spark, nothing) == 0 and stored(spark, t) == [(5, 2024, 12)]
    assert list_files(spark, path).count() == 1
    with pytest.raises(Exception, match="outside"):
        stage_period(frame(spark, (1, 2024, 3)), t, path, {"year": 2024, "month": 4})
    assert stored(spark, t) == [(5, 2024, 12)] and not left_behind(path)


def test_a_staged_period_in_padded_directories(spark, scratch):
    t, path = fresh_name(), scratch + "/t"
    overwrite_partitions(frame(spark, (1, 2024, 3), (2, 2024, 4)), t, path)
    os.rename(path + "/year=2024/month=3", path + "/year=2024/month=03")
    spark.sql(f"MSCK REPAIR TABLE {t} SYNC PARTITIONS")
    publish_period(spark, stage_period(frame(spark, (8, 2024, 3)), t, path, {"year": 2024, "month": 3}))
    assert stored(spark, t) == [(2, 2024, 4), (8, 2024, 3)]


def test_a_month_that_has_not_arrived(spark, landing):
    root, _, weather = landing
    with pytest.raises(FileNotFoundError):
        run_month(spark, lake_of(spark, root), 2024, 6, root + "/landing", weather(2024), SMALL)


def test_content_checks_wait_for_the_files(spark, landing):
    root, _, _ = landing
    lake = lake_of(spark, root)
    rows = suites.gold_suite(spark, lake, 2024, 1, SMALL)
    assert [r.check_name for r in rows] == ["s3_object_exists", "s3_file_size"] * 2
    rows = suites.silver_trip_suite(spark, lake, 2024, 1, SMALL)
    assert not suites.verdict(rows) and "row_count_floor" not in {r.check_name for r in rows}
