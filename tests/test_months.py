"""Months as directories: landing, replacing, reading and registering them, on files."""

import datetime as dt
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import checks as c
from lodestrata.operators.periods import missing_periods
from lodestrata.plans import suites
from lodestrata.plans.monthly import land_weather, run_month, silver_trips
from lodestrata.sources.inventory import (
    file_inventory,
    folders,
    list_files,
    loaded_periods,
    partition_years,
)
from lodestrata.sources.lake import (
    land_periods,
    overwrite_partitions,
    read_partition,
    register_external,
    schema_groups,
)
from lodestrata.sources.schemas import merged
from tests.test_lake import SMALL, frame, fresh_name, lake_of, landing, stored  # noqa: F401


def put(path, columns, **options):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path, **options)


def land(spark, root, months, **options):
    return land_periods(spark, root + "/landing", root + "/bronze", months, name_pattern="t*_{year}-{month:02d}.parquet", **options)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- landing ---------------------------------------------------------------------------


def test_files_of_a_month_with_different_columns(spark, scratch):
    put(scratch + "/landing/t1_2024-01.parquet", {"id": [1, 2], "a": ["x", "y"]})
    put(scratch + "/landing/t2_2024-01.parquet", {"ID": [3], "fee": [2.5]})
    (outcome,) = land(spark, scratch, [(2024, 1)])
    assert outcome["success"] and outcome["rows"] == 3 and outcome["error"] is None
    assert outcome["path"].endswith("/bronze/year=2024/month=1")
    df = spark.read.parquet(outcome["path"])
    assert df.columns == ["id", "a", "fee"]
    assert values(df, "id", "a", "fee") == [(1, "x", None), (2, "y", None), (3, None, 2.5)]


def test_types_that_disagree_within_a_month_are_refused(spark, scratch):
    put(scratch + "/landing/t1_2024-01.parquet", {"id": [1], "n": [1]})
    put(scratch + "/landing/t2_2024-01.parquet", {"id": [2], "n": [1.5]})
    put(scratch + "/landing/t1_2024-02.parquet", {"id": [3]})
    one, two = land(spark, scratch, [(2024, 1), (2024, 2)])
    assert not one["success"] and two["success"]
    assert "column n is bigint and double" in one["error"] and "t2_2024-01" in one["error"]
    assert not os.path.exists(scratch + "/bronze/year=2024/month=1")


def test_the_cause_of_a_failed_job_is_kept(spark, scratch):
    put(scratch + "/landing/t1_2024-01.parquet", {"id": list(range(1000))})
    path = scratch + "/landing/t1_2024-01.parquet"
    with open(path, "r+b") as f:
        f.seek(4)
        f.write(b"\xff" * 200)
    (outcome,) = land(spark, scratch, [(2024, 1)])
    assert not outcome["success"]
    assert "An error occurred while calling" not in outcome["error"] and len(outcome["error"]) > 10
    (outcome,) = land(spark, scratch, [(2024, 7)])
    assert "no files of 2024-07" in outcome["error"]


def test_a_padded_month_is_landed_where_it_is(spark, scratch):
    put(scratch + "/landing/t1_2024-03.parquet", {"id": [1, 2, 3]})
    put(scratch + "/bronze/year=2024/month=03/old.parquet", {"id": [7, 8]})
    (outcome,) = land(spark, scratch, [(2024, 3)])
    assert outcome["skipped"] and outcome["path"].endswith("month=03")
    (outcome,) = land(spark, scratch, [(2024, 3)], skip_existing=False)
    assert outcome["success"] and os.listdir(scratch + "/bronze/year=2024") == ["month=03"]
    assert read_partition(spark, scratch + "/bronze", 2024, 3).count() == 3
    # Both spellings, left by earlier runs: one stays.
    put(scratch + "/bronze/year=2024/month=3/part-0.parquet", {"id": [9]})
    land(spark, scratch, [(2024, 3)], skip_existing=False)
    assert len(os.listdir(scratch + "/bronze/year=2024")) == 1
    assert read_partition(spark, scratch + "/bronze", 2024, 3).count() == 3


def test_a_month_without_its_marker_is_landed_again(spark, scratch):
    put(scratch + "/landing/t1_2024-01.parquet", {"id": [1, 2, 3]})
    folder = scratch + "/bronze/year=2024/month=1"
    put(folder + "/part-00000-x.snappy.parquet", {"id": [1]})
    wanted = spark.createDataFrame([(2024, 1)], "year int, month int")
    loaded = loaded_periods(spark, scratch + "/bronze")
    assert loaded.count() == 0 and missing_periods(wanted, loaded).count() == 1
    (outcome,) = land(spark, scratch, [(2024, 1)])
    assert outcome["success"] and not outcome["skipped"]
    assert loaded_periods(spark, scratch + "/bronze").count() == 1
    assert land(spark, scratch, [(2024, 1)])[0]["skipped"]


def test_files_of_other_tools(spark, scratch):
    """Whole files, one or several, are a loaded month; one of them cut off is not."""
    put(scratch + "/b/year=2024/month=1/yellow.parquet", {"id": [1]})
    put(scratch + "/b/year=2024/month=2/a.parquet", {"id": [1]})
    put(scratch + "/b/year=2024/month=2/b.parquet", {"id": [1]})
    put(scratch + "/b/year=2024/month=3/cut.parquet", {"id": [1]})
    put(scratch + "/b/year=2024/month=3/whole.parquet", {"id": [1]})
    with open(scratch + "/b/year=2024/month=3/cut.parquet", "r+b") as f:
        f.truncate(100)
    assert values(loaded_periods(spark, scratch + "/b"), "year", "month") == [(2024, 1), (2024, 2)]


# --- file counts ------------------------------------------------------------------------


def test_three_million_rows_in_a_dozen_row_groups(spark, scratch):
    n = 3_000_000
    ids = pa.array(range(n))
    put(scratch + "/landing/t1_2024-01.parquet", {"id": ids, "v": ids}, row_group_size=n // 12)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")  # as many splits as on many cores
    try:
        (outcome,) = land(spark, scratch, [(2024, 1)])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert outcome["rows"] == n
    inventory = file_inventory(spark, scratch + "/bronze", year=2024, month=1)
    rows = suites.file_checks(inventory, suites.DEFAULTS.bronze_trips, "bronze", "t", 2024, 1).collect()
    assert all(r.passed for r in rows), rows


def test_more_than_200_shuffle_partitions_make_few_files(spark, scratch):
    t = fresh_name()
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        df = spark.range(20000).selectExpr("id % 9973 AS v", "2024 AS year", "1 AS month")
        overwrite_partitions(df.groupBy("v", "year", "month").count(), t, scratch + "/t")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert list_files(spark, scratch + "/t", year=2024, month=1).count() <= 4
    assert spark.table(t).count() == 9973


@pytest.mark.parametrize("files, size, passed", [(5, 1, True), (6, 1, False), (600, 600 * 2**23, True), (600, 600 * 2**20, False)])
def test_ceiling_grows_with_bytes(spark, files, size, passed):
    inventory = spark.createDataFrame([(2024, 1, files, size)], "year int, month int, files long, bytes long")
    check = c.file_count(1, 5, bytes_per_file=suites.BYTES_PER_FILE)
    row = c.run_checks({"files": inventory}, [check], "bronze", "t", 2024, 1).first()
    assert row.passed is passed, row.message


# --- one month, one partition --------------------------------------------------------------


@pytest.mark.parametrize("scope", [None, {"year": 2024, "month": 3}, {"year": 2024}])
def test_a_padded_partition_is_replaced(spark, scratch, scope):
    put(scratch + "/t/year=2024/month=03/a.parquet", {"v": pa.array([1], pa.int32())})
    put(scratch + "/t/year=2024/month=4/a.parquet", {"v": pa.array([2], pa.int32())})
    put(scratch + "/t/year=2023/month=03/a.parquet", {"v": pa.array([3], pa.int32())})
    t = fresh_name()
    for _ in range(2):
        overwrite_partitions(frame(spark, (9, 2024, 3)), t, scratch + "/t", scope=scope)
        others = [(2, 2024, 4)] if scope != {"year": 2024} else []
        assert stored(spark, t) == sorted([(3, 2023, 3), (9, 2024, 3), *others])
    assert [f.spelled for f in folders(spark, scratch + "/t", 2024, 3)] == ["year=2024/month=3"]


def test_an_emptied_padded_partition(spark, scratch):
    put(scratch + "/t/year=2024/month=03/a.parquet", {"v": pa.array([1], pa.int32())})
    t = fresh_name()
    nothing = frame(spark, (9, 2024, 3)).filter("v > 9")
    overwrite_partitions(nothing, t, scratch + "/t", scope={"year": 2024, "month": 3})
    assert stored(spark, t) == []


# --- drifting months ------------------------------------------------------------------------


def drifting(root):
    put(root + "/year=2024/month=1/a.parquet", {"id": [1, 2], "n": [1, None]})
    put(root + "/year=2024/month=02/a.parquet", {"id": [3], "n": [2.5], "Fee": [7]})
    put(root + "/year=2024/month=2/b.parquet", {"id": [4], "n": [3], "fee": [8]})
    put(root + "/year=2024/month=3/a.parquet", {"ID": [5], "FEE": [9]})


WHOLE = [(1, 1.0, None, 1), (2, None, None, 1), (3, 2.5, 7, 2), (4, 3.0, 8, 2), (5, None, 9, 3)]


def test_reading_drifting_months(spark, scratch):
    drifting(scratch + "/r")
    year = read_partition(spark, scratch + "/r", 2024)
    assert values(year, "id", "n", "fee", "month") == WHOLE
    assert dict(year.dtypes)["n"] == "double"
    two = read_partition(spark, scratch + "/r", 2024, 2)
    assert values(two, "id", "n", "fee", "month") == WHOLE[2:4]
    assert values(read_partition(spark, scratch + "/r", 2024, 3), "id", "fee") == [(5, 9)]
    assert values(read_partition(spark, scratch + "/r", 2024, 1), "id", "n") == [(1, 1), (2, None)]


def test_registering_drifting_months(spark, scratch):
    drifting(scratch + "/r")
    t = fresh_name()
    for _ in range(2):
        register_external(spark, t, scratch + "/r")
        assert values(spark.table(t), "id", "n", "fee", "month") == WHOLE
        assert spark.table(t).filter("year = 2024 AND month = 3").count() == 1


def test_a_table_whose_type_starts_to_drift(spark, scratch):
    put(scratch + "/r/year=2024/month=1/a.parquet", {"id": [1], "n": [1]})
    t = fresh_name()
    register_external(spark, t, scratch + "/r")
    assert spark.catalog.getTable(t).tableType == "EXTERNAL"
    put(scratch + "/r/year=2024/month=2/a.parquet", {"id": [2], "Extra": ["x"]})
    register_external(spark, t, scratch + "/r")
    assert spark.catalog.getTable(t).tableType == "EXTERNAL"
    assert values(spark.table(t), "id", "n", "extra") == [(1, 1, None), (2, None, "x")]
    put(scratch + "/r/year=2024/month=3/a.parquet", {"id": [3], "n": [1.5]})
    register_external(spark, t, scratch + "/r")
    assert values(spark.table(t), "id", "n", "extra") == [(1, 1.0, None), (2, None, "x"), (3, 1.5, None)]


def test_a_month_that_is_landed_again(spark, scratch):
    for m in (1, 2):
        put(scratch + f"/r/year=2024/month={m}/a.parquet", {"id": [m], "n": [m]})
    t = fresh_name()
    register_external(spark, t, scratch + "/r")
    put(scratch + "/r/year=2024/month=1/a.parquet", {"id": [1], "n": [1], "extra": ["x"]})
    register_external(spark, t, scratch + "/r")
    assert spark.catalog.getTable(t).tableType == "EXTERNAL"
    assert values(spark.table(t), "id", "n", "extra") == [(1, 1, "x"), (2, 2, None)]
    put(scratch + "/r/year=2024/month=1/a.parquet", {"id": [1], "n": [1.5], "extra": ["x"]})
    register_external(spark, t, scratch + "/r")
    assert values(spark.table(t), "id", "n", "extra") == [(1, 1.5, "x"), (2, 2.0, None)]


def jobs_of(spark, action):
    group = fresh_name()
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_twenty_years_with_three_drifts(spark, scratch, monkeypatch):
    root, want = scratch + "/r", []
    for i in range(240):
        n = i if i < 50 else i + 0.5 if i < 120 else str(i) if i < 200 else i  # int, double, text, int again
        put(f"{root}/year={2000 + i // 12}/month={i % 12 + 1}/a.parquet", {"id": [i], "n": [n], **({"x": [i]} if i > 220 else {})})
        want.append((i, str(n), i if i > 220 else None, 2000 + i // 12, i % 12 + 1))
    t = fresh_name()
    jobs = jobs_of(spark, lambda: register_external(spark, t, root))
    assert jobs < 120
    assert values(spark.table(t), "id", "n", "x", "year", "month") == sorted(want, key=str)
    plan = spark.table(t)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 3 and spark.table(t).filter("year = 2010 AND month = 3").first().id == 122
    names = {r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(t + "__types")}
    assert len(names) == 3
    opened = []
    from lodestrata.sources import lake as module
    whole = module.schema_groups
    monkeypatch.setattr(module, "schema_groups", lambda s, found: (opened.append([f.spelled for f in found]), whole(s, found))[1])
    register_external(spark, t, root)
    put(f"{root}/year=2020/month=1/a.parquet", {"id": [240], "n": ["z"]})
    put(f"{root}/year=2000/month=2/a.parquet", {"id": [1], "n": ["one"]})  # now text
    shutil.move(f"{root}/year=2000/month=3", scratch + "/gone")
    register_external(spark, t, root)
    assert opened == [[], ["year=2000/month=2", "year=2020/month=1"]]
    got = {r[0]: r[1] for r in values(spark.table(t), "id", "n")}
    assert (got[1], got[240], got[0]) == ("one", "z", "0") and 2 not in got and len(got) == 240
    # Two directories of one month that agree in types.
    put(f"{root}/year=2020/month=01/a.parquet", {"id": [241], "n": ["y"]})
    register_external(spark, t, root)
    assert values(spark.table(t).filter("year = 2020"), "id") == [(240,), (241,)]


def test_footers_of_all_months_in_one_job(spark, scratch):
    for m in range(1, 13):
        put(f"{scratch}/r/year=2024/month={m}/a.parquet", {"id": [m], f"x{m}": [m]})
    groups = []
    found = folders(spark, scratch + "/r")[1:]
    assert jobs_of(spark, lambda: groups.extend(schema_groups(spark, found))) <= 2
    assert [len(g.schema) for g in groups] == [13]


def test_files_of_one_month_that_disagree(spark, scratch):
    put(scratch + "/r/year=2024/month=1/a.parquet", {"id": [1], "n": [1]})
    put(scratch + "/r/year=2024/month=1/b.parquet", {"id": [2], "n": ["b"]})
    put(scratch + "/r/year=2024/month=2/a.parquet", {"id": [3], "n": ["c"]})
    t = fresh_name()
    for _ in range(2):
        register_external(spark, t, scratch + "/r")
        assert values(spark.table(t), "id", "n", "month") == [(1, "1", 1), (2, "b", 1), (3, "c", 2)]
    assert values(read_partition(spark, scratch + "/r", 2024), "id", "n", "month") == [(1, "1", 1), (2, "b", 1), (3, "c", 2)]


def test_merged_schemas(spark):
    a, b = (spark.createDataFrame([], s).schema for s in ("a int, b date, c string", "A bigint, b timestamp, c double, d int"))
    whole = merged([a, b], widen=True)
    assert [(f.name, f.dataType.simpleString()) for f in whole] == [
        ("a", "bigint"), ("b", "timestamp"), ("c", "string"), ("d", "int"),
    ]


# --- listings ----------------------------------------------------------------------------


def tasks_of(spark, action):
    group = fresh_name()
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        return sum(tracker.getStageInfo(s).numTasks for s in stages)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_listings_take_no_task_for_a_file(spark, scratch):
    for m in range(1, 13):
        for i in range(20):
            put(f"{scratch}/p/year=2024/month={m}/f{i}.parquet", {"v": [i]})
        open(f"{scratch}/p/year=2024/month={m}/_SUCCESS", "w").close()
    assert tasks_of(spark, lambda: folders(spark, scratch + "/p")) == 0
    few = spark.sparkContext.defaultParallelism
    found = []
    assert tasks_of(spark, lambda: found.extend(loaded_periods(spark, scratch + "/p").collect())) <= few
    assert len(found) == 12
    check = c.unexpected_partitions([2024])

    def judge():
        years = partition_years(spark, scratch + "/p")
        found.append(c.run_checks({"partitions": years}, [check], "silver", "t", 2024, 1).first())

    assert tasks_of(spark, judge) <= 2 * few + 2
    assert found[-1].passed


def test_files_are_listed_by_directories(spark, scratch):
    root = scratch + "/p"
    for y in (2022, 2023, 2024):
        for m in range(1, 13):
            os.makedirs(f"{root}/year={y}/month={m:02d}/deeper/year=9")
            for name in ("a.parquet", "b.parquet", "_c.parquet", ".d.parquet", "e.csv", "deeper/f.parquet"):
                with open(f"{root}/year={y}/month={m:02d}/{name}", "w") as f:
                    f.write("x" * m)
    for extra in ("top.parquet", "year=2024/own.parquet", "other/z.parquet"):
        os.makedirs(os.path.dirname(f"{root}/{extra}"), exist_ok=True)
        with open(f"{root}/{extra}", "w") as f:
            f.write("y")
    for empty in ("none.parquet", "year=2024/none.parquet", "year=2024/month=01/none.parquet"):
        open(f"{root}/{empty}", "w").close()
    few = spark.sparkContext.defaultParallelism
    got = []
    # a task for each of 36 directories to list, as many to read, and the driver's own rows
    assert tasks_of(spark, lambda: got.extend(list_files(spark, root).collect())) <= 2 * 36 + few
    want = [(f"file:{root}/year={y}/month={m:02d}/{n}.parquet", m, y, m)
            for y in (2022, 2023, 2024) for m in range(1, 13) for n in "ab"]
    want += [(f"file:{root}/top.parquet", 1, None, None), (f"file:{root}/year=2024/own.parquet", 1, 2024, None)]
    assert sorted((r.path, r.length, r.year, r.month) for r in got) == sorted(want)
    one = next(r for r in got if r.path.endswith("/year=2024/month=03/a.parquet"))
    changed = os.path.getmtime(f"{root}/year=2024/month=03/a.parquet")
    assert abs(one.modificationTime.replace(tzinfo=dt.UTC).timestamp() - changed) < 0.01
    assert list_files(spark, root, year=2023, month=3).count() == 2
    assert list_files(spark, root, year=2024).count() == 25
    assert [r.path[-5:] for r in list_files(spark, root, "*.csv", 2022, 1).collect()] == ["e.csv"]
    # A partition directory, and one without partitions, as datasets of their own.
    alone = list_files(spark, f"{root}/year=2024/month=03").collect()
    assert sorted((r.path[-9:], r.year) for r in alone) == [("a.parquet", None), ("b.parquet", None)]
    assert list_files(spark, root, year=1999).count() == list_files(spark, scratch + "/none").count() == 0
    totals = {(r.year, r.month): (r.files, r.bytes) for r in file_inventory(spark, root).collect()}
    assert totals[2023, 12] == (2, 24) and totals[None, None] == (1, 1) and len(totals) == 38


# --- the job ------------------------------------------------------------------------------


def test_two_ranges_on_one_column(spark):
    rows = spark.range(100)
    ranges = [c.Range("id", 0, 10), c.Range("id", 0, 1000), c.Range("id", -5, 10.5)]
    row = c.run_checks({"rows": rows}, [c.value_ranges(ranges)], "silver", "t", 2024, 1).first()
    assert not row.passed
    assert "id in [0, 10]=89.00%" in row.message and "1000" not in row.message and "[-5, 10.5]" in row.message


def test_the_same_survivor_in_every_run(spark, landing):  # noqa: F811
    root, month, _ = landing
    month(2024, 1, 31)
    raw = spark.read.parquet(root + "/landing/yellow_tripdata_2024-01.parquet")
    rich = raw.withColumn("tip_amount", F.col("tip_amount") + 5)
    poor = raw.withColumn("passenger_count", F.lit(3.0))
    results = []
    for seed, parts in ((1, 3), (2, 7)):
        lake = lake_of(spark, f"{root}/{seed}")
        lake.create_layers(spark)
        shuffled = raw.unionByName(rich).unionByName(poor).orderBy(F.rand(seed)).repartition(parts)
        shuffled.write.parquet(lake.path("bronze", *suites.TRIP_SOURCE, 2024, 1))
        silver_trips(spark, lake, 2024, 1)
        silver = spark.table(lake.table("silver", suites.TRIP_TABLE))
        results.append(sorted(map(str, silver.select(sorted(silver.columns)).collect())))
    assert results[0] == results[1] and len(results[0]) == 31 * 12


def test_december_and_january_with_default_years(spark, landing):  # noqa: F811
    root, month, weather = landing
    lake = lake_of(spark, root)
    limits = suites.SuiteLimits(
        bronze_trips=suites.FileLimits(100, 5), silver_trips=suites.FileLimits(100, 200), min_rows=10
    )
    month(2023, 12, 31)
    month(2024, 1, 31)
    run_month(spark, lake, 2023, 12, root + "/landing", weather(2023), limits)
    out = run_month(spark, lake, 2024, 1, root + "/landing", weather(2024), limits)
    assert all(r.passed for rows in out.checks.values() for r in rows)
    # A year that was never landed is still found.
    stray = frame(spark, (1, 2002, 7)).write.partitionBy("year", "month")
    stray.mode("append").parquet(lake.path("silver", *suites.TRIP_SOURCE))
    rows = suites.silver_trip_suite(spark, lake, 2024, 1, limits)
    assert [r.check_name for r in rows if not r.passed] == ["no_unexpected_partitions"]


def test_the_weather_of_a_running_year_is_read_again(spark, landing):  # noqa: F811
    root, _, weather = landing
    lake = lake_of(spark, root)
    later = {dt.date(2024, 2, 1) + dt.timedelta(days=i) for i in range(335)}
    csv = weather(2024, skip=later)
    first = land_weather(spark, lake, csv, 2024, through=dt.date(2024, 1, 31))
    assert first["success"] and first["rows"] == 31 and first["path"].endswith("year=2024")
    assert land_weather(spark, lake, csv, 2024, through=dt.date(2024, 1, 31))["skipped"]
    weather(2024)
    assert land_weather(spark, lake, csv, 2024)["skipped"]
    again = land_weather(spark, lake, csv, 2024, through=dt.date(2024, 2, 29))
    assert not again["skipped"] and again["rows"] == 366
    shutil.rmtree(os.path.join(first["path"].removeprefix("file:"), "_SUCCESS"), ignore_errors=True)
    bad = land_weather(spark, lake, root + "/landing/absent.csv", 2025)
    assert not bad["success"] and "absent.csv" in bad["error"]


def test_shuffles_of_gold_and_weather_grow_with_the_input(spark, landing, monkeypatch):  # noqa: F811
    import lodestrata.session as session
    from lodestrata.plans import monthly

    root, month, weather = landing
    lake = lake_of(spark, root)
    month(2024, 1, 31)
    monkeypatch.setattr(session, "SHUFFLE_BYTES_PER_TASK", 1000)
    seen = []
    inner = monthly.stage_period

    def spy(df, table, *args, **options):
        seen.append((table, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        return inner(df, table, *args, **options)

    monkeypatch.setattr(monthly, "stage_period", spy)
    run_month(spark, lake, 2024, 1, root + "/landing", weather(2024), SMALL)
    by = {t.split(".")[1]: n for t, n in seen}
    assert by["trip_weather_daily"] > 4 and by["location_hourly_features"] > 4 and by["yellow_taxi_trips"] > 4
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
