"""Quality checks on tables that pass and tables that do not."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestrata.functions import calendar
from lodestrata.operators import checks as c
from lodestrata.operators import periods
from lodestrata.plans import suites
from lodestrata.plans.suites import gated, verdict



def judge(check, **tables):
    out = c.run_checks(tables, [check], "silver", "t", 2024, 12).collect()
    assert len(out) == 1
    assert (out[0].layer, out[0].table_name, out[0].year, out[0].month) == ("silver", "t", 2024, 12)
    return out[0]


def numbers(spark, n, **columns):
    df = spark.range(n)
    return df.withColumns({k: F.expr(v) for k, v in columns.items()})


def test_row_count_floor(spark):
    assert judge(c.row_count_floor(1500), rows=spark.range(1500)).passed
    failed = judge(c.row_count_floor(1500), rows=spark.range(50))
    assert (failed.passed, failed.severity, failed.metric_value, failed.threshold) == (
        False, "error", 50.0, 1500.0,
    )
    assert not judge(c.row_count_floor(), rows=spark.range(50)).passed


def history(spark, **counts):
    """Rows per month of 2024, as m9=1000."""
    return spark.createDataFrame(
        [(2024, int(k[1:]), i) for k, n in counts.items() for i in range(n)],
        "year int, month int, i int",
    )


@pytest.mark.parametrize(
    "counts, passed, metric",
    [
        (dict(m12=100), True, None),
        (dict(m10=100, m11=100, m12=1), True, None),
        (dict(m9=100, m10=100, m11=100, m12=10), False, 10.0),
        (dict(m9=100, m10=100, m11=100, m12=50), True, 50.0),
        (dict(m9=100, m10=100, m11=100, m12=150), True, 150.0),
        (dict(m9=100, m10=100, m11=100, m12=151), False, 151.0),
        (dict(m9=100, m10=100, m11=100), False, 0.0),
    ],
)
def test_row_count_trend(spark, counts, passed, metric):
    table = c.trend_history(history(spark, **counts), 2024, 12)
    row = judge(c.row_count_trend(2024, 12), history=table)
    assert (row.passed, row.severity, row.metric_value) == (passed, "warn", metric)


def test_trend_months():
    assert c.trend_months(2024, 2) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_null_rates(spark):
    check = c.null_rates(["a", "b"])
    few = numbers(spark, 1000, a="if(id < 2, null, id)", b="id")
    many = numbers(spark, 1000, a="if(id < 50, null, id)", b="id")
    assert judge(check, rows=few).passed
    failed = judge(check, rows=many)
    assert not failed.passed and "a=5.00%" in failed.message and "b=" not in failed.message
    assert judge(check, rows=numbers(spark, 100, a="if(id < 1, null, id)", b="id")).passed


def test_value_ranges(spark):
    check = c.value_ranges([c.Range("p", 1, 8)])
    assert judge(check, rows=numbers(spark, 1000, p="id % 8 + 1")).passed
    assert judge(check, rows=numbers(spark, 1000, p="if(id < 5, 9, 8)")).passed
    failed = judge(check, rows=numbers(spark, 1000, p="if(id < 20, 0, 1)"))
    assert not failed.passed and "p=2.00%" in failed.message
    assert judge(check, rows=numbers(spark, 10, p="cast(null as int)")).passed
    open_low = c.value_ranges([c.Range("p", 0, 8, low_inclusive=False)])
    assert not judge(open_low, rows=numbers(spark, 10, p="0")).passed


def test_empty_period_fails_with_a_message(spark):
    empty = numbers(spark, 0, a="id", avg_fare="1.0D")
    for check in (
        c.null_rates(["a"]),
        c.value_ranges([c.Range("a", 0, 1)]),
        c.stat_bounds("avg(avg_fare)", 5, 50),
    ):
        row = judge(check, rows=empty)
        assert (row.passed, row.message, row.metric_value) == (False, c.NO_ROWS, None)


def days(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "d string").select(
        F.col("d").cast("date").alias("d")
    )


def test_dates_in_partition(spark):
    check = c.dates_in_partition("d", 2024, 12)
    assert judge(check, rows=days(spark, "2024-12-01", "2024-12-31")).passed
    failed = judge(check, rows=days(spark, "2024-12-01", "2024-11-30", "2002-12-01"))
    assert (failed.passed, failed.metric_value, failed.threshold) == (False, 2.0, 0.0)


def test_calendar_completeness(spark):
    def month(year, number, last):
        return days(spark, *(f"{year}-{number:02d}-{d:02d}" for d in range(1, last + 1)))

    assert judge(c.calendar_completeness("d", 2024, 12), rows=month(2024, 12, 31)).passed
    assert judge(c.calendar_completeness("d", 2024, 2), rows=month(2024, 2, 29)).passed
    assert judge(c.calendar_completeness("d", 2023, 2), rows=month(2023, 2, 28)).passed
    failed = judge(c.calendar_completeness("d", 2024, 12), rows=month(2024, 12, 30))
    assert (failed.passed, failed.metric_value, failed.threshold) == (False, 30.0, 31.0)
    assert "2024-12-31" in failed.message


@pytest.mark.parametrize(
    "raw, clean, passed, metric",
    [(1000, 900, True, 0.9), (1000, 100, False, 0.1), (1000, 1200, False, 1.2), (0, 5, False, None)],
)
def test_cross_layer_counts(spark, raw, clean, passed, metric):
    row = judge(c.cross_layer_counts(), bronze=spark.range(raw), silver=spark.range(clean))
    assert (row.passed, row.metric_value) == (passed, metric)


@pytest.mark.parametrize("total, passed", [(1000, True), (990, False)])
def test_gold_reconciliation(spark, total, passed):
    gold = spark.createDataFrame([(total - 10,), (10,)], "total_trips bigint")
    row = judge(c.gold_reconciliation(), gold=gold, silver=spark.range(1000))
    assert (row.passed, row.metric_value, row.threshold) == (passed, float(total), 1000.0)


def test_gold_reconciliation_of_nothing(spark):
    gold = spark.createDataFrame([], "total_trips bigint")
    assert not judge(c.gold_reconciliation(), gold=gold, silver=spark.range(0)).passed


@pytest.mark.parametrize("value, passed", [(18.5, True), (120.0, False), (5.0, True), (50.0, True)])
def test_stat_bounds(spark, value, passed):
    rows = spark.createDataFrame([(value,)], "avg_fare double")
    row = judge(c.stat_bounds("avg(avg_fare)", 5, 50, "avg_fare"), rows=rows)
    assert (row.passed, row.severity, row.metric_value, row.threshold) == (passed, "warn", value, 50.0)


def inventory(spark, *files, age_hours=1):
    newest = dt.datetime(2024, 12, 31, 12) - dt.timedelta(hours=age_hours)
    return spark.createDataFrame(
        [(y, m, n, size, newest) for y, m, n, size in files],
        "year int, month int, files bigint, bytes bigint, newest timestamp",
    )


def test_files(spark):
    some = inventory(spark, (2024, 12, 3, 15_000_000))
    none = inventory(spark)
    assert judge(c.files_exist(), files=some).passed
    assert not judge(c.files_exist(), files=none).passed
    assert judge(c.total_bytes(1_000_000), files=some).passed
    assert not judge(c.total_bytes(1_000_000), files=inventory(spark, (2024, 12, 1, 100))).passed
    empty = judge(c.total_bytes(), files=none)
    assert (empty.passed, empty.metric_value, empty.threshold) == (False, None, None)
    assert judge(c.file_count(1, 5), files=some).passed
    assert not judge(c.file_count(1, 2), files=some).passed
    assert not judge(c.file_count(1, 2), files=none).passed


def test_freshness(spark):
    now = F.lit("2024-12-31 12:00:00").cast("timestamp")
    fresh = judge(c.freshness(48, now), files=inventory(spark, (2024, 12, 1, 1)))
    assert fresh.passed and fresh.metric_value == 1.0
    assert not judge(c.freshness(48, now), files=inventory(spark, (2024, 12, 1, 1), age_hours=100)).passed
    assert not judge(c.freshness(48, now), files=inventory(spark)).passed


def test_unexpected_partitions(spark):
    table = inventory(spark, (2024, 12, 1, 1), (2024, 11, 1, 1))
    assert judge(c.unexpected_partitions([2024]), partitions=table).passed
    stray = inventory(spark, (2024, 12, 1, 1), (2002, 7, 1, 1), (None, None, 1, 1))
    failed = judge(c.unexpected_partitions([2024]), partitions=stray)
    assert not failed.passed and "2002" in failed.message
    assert not judge(c.unexpected_partitions([2002, 2024]), partitions=stray).passed
    two = inventory(spark, (2023, 1, 1, 1), (2024, 1, 1, 1))
    assert judge(c.unexpected_partitions([2023, 2024]), partitions=two).passed


def results(spark, *rows):
    return spark.createDataFrame(
        [("silver", "t", 2024, 12, "x", passed, "m", None, None, severity) for passed, severity in rows],
        c.CHECK_SCHEMA,
    )


@pytest.mark.parametrize(
    "given, passed",
    [
        ([(True, "error"), (True, "warn")], True),
        ([(True, "error"), (False, "warn")], True),
        ([(False, "error"), (True, "warn")], False),
    ],
)
def test_verdict(spark, given, passed):
    df = results(spark, *given)
    assert c.evaluate_checks(df).first().passed is passed
    assert verdict(df.collect()) is passed


def test_gate(spark):
    second = results(spark, (True, "error"))
    assert len(gated(results(spark, (True, "error")), lambda: second)) == 2
    assert len(gated(results(spark, (False, "warn")), lambda: second)) == 2

    def never():
        raise AssertionError("content checks ran")

    assert len(gated(results(spark, (False, "error"), (True, "error")), never)) == 2


def test_a_suite_reads_its_table_once(spark):
    checks = [
        c.row_count_floor(1), c.null_rates(["a"]), c.value_ranges([c.Range("a", 0, 9)]),
        c.dates_in_partition("d", 2024, 12), c.stat_bounds("avg(a)", 0, 9),
    ]
    df = numbers(spark, 10, a="id", d="date'2024-12-01'")
    out = c.run_checks({"rows": df}, checks, "silver", "t", 2024, 12)
    assert [r.check_name for r in out.collect()] == [
        "row_count_floor", "null_rates", "value_ranges", "dates_in_partition", "stat_bounds",
    ]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def rows_read(spark, action):
    """Rows that each stage of an action takes from files."""
    group = f"cost-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tracker, store = spark.sparkContext.statusTracker(), spark._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sorted(n for n in (store.lastStageAttempt(s).inputRecords() for s in stages) if n)


def pruning_checks():
    ranges = [c.Range("fare", 0, 1000, low_inclusive=False), c.Range("zone", 1, 265), c.Range("zone", 1, 300)]
    return [
        c.row_count_floor(1), c.null_rates(["fare", "zone", "d"]), c.value_ranges(ranges),
        c.dates_in_partition("d", 2024, 12), c.stat_bounds("avg(zone)", 0, 300),
    ]


@pytest.mark.parametrize(
    "fare, zone, day",
    [
        ("1.0D + id % 900", "1 + id % 265", "date'2024-12-05'"),  # nothing amiss
        ("if(id < 900, null, if(id < 2000, -1.0D, 5.0D))", "if(id > 98000, 400, 7)", "date'2024-12-01'"),
        ("if(id % 3 = 0, double('NaN'), 2.0D)", "if(id % 7 = 0, 0, 280)", "if(id % 5 = 0, date'2025-01-01', null)"),
        ("cast(null as double)", "cast(null as int)", "cast(null as date)"),
    ],
)
def test_pruned_facts_are_those_of_the_scan(spark, scratch, fare, zone, day):
    path = scratch + "/t"
    numbers(spark, 100_000, fare=fare, zone=zone, d=day).coalesce(2).write.option("parquet.block.size", 65536).parquet(path)
    df = spark.read.parquet(path)
    plain, pruned = (
        c.run_checks({"rows": df}, pruning_checks(), "silver", "t", 2024, 12, pruned=p).collect() for p in ((), ("rows",))
    )
    assert plain == pruned
    nothing = {"rows": df.filter("zone > 100000")}
    assert (
        c.run_checks(nothing, pruning_checks(), "silver", "t", 2024, 12).collect()
        == c.run_checks(nothing, pruning_checks(), "silver", "t", 2024, 12, pruned=("rows",)).collect()
    )


def test_pruned_facts_read_only_groups_with_unwanted_rows(spark, scratch):
    path = scratch + "/t"
    rows = numbers(spark, 400_000, fare="1.0D + rand(1) * 900", zone="if(id < 100, 400, cast(1 + rand(2) * 264 as int))",
                   d="date'2024-12-05'").coalesce(1)
    rows.write.option("parquet.block.size", 262144).parquet(path)
    groups = [pq.ParquetFile(f"{path}/{f}").num_row_groups for f in os.listdir(path) if f.endswith(".parquet")]
    assert sum(groups) > 4
    checks = pruning_checks()[:4]

    def judged(pruned):
        got = []
        out = c.run_checks({"rows": spark.read.parquet(path)}, checks, "silver", "t", 2024, 12, pruned=pruned)
        return got, rows_read(spark, lambda: got.extend(out.collect())), out._jdf.queryExecution().toString()

    whole, all_rows, _ = judged(())
    few, (some, counted), plan = judged(("rows",))
    assert whole == few
    assert all_rows == [400_000]
    # The plain count takes rows without any column; the other scan one row group of many.
    assert counted == 400_000 and "ReadSchema: struct<>" in plan
    assert 100 <= some < 400_000 / 4


def test_conflicting_facts_are_refused(spark):
    with pytest.raises(ValueError):
        c.run_checks(
            {"rows": spark.range(3)},
            [c.stat_bounds("avg(id)", 0, 1), c.stat_bounds("max(id)", 0, 1)],
            "silver", "t", 2024, 12,
        )


# --- periods ------------------------------------------------------------------------


def pairs(df):
    return sorted((r.year, r.month) for r in df.select("year", "month").collect())


@pytest.mark.parametrize(
    "as_of, expected",
    [
        (dt.date(2024, 4, 30), (2024, 2)),
        (dt.date(2024, 2, 29), (2023, 12)),
        (dt.date(2024, 1, 1), (2023, 11)),
        (dt.date(2024, 12, 31), (2024, 10)),
    ],
)
def test_latest_published(spark, as_of, expected):
    assert calendar.latest_published(as_of) == expected
    row = spark.range(1).select(calendar.lagged_period(F.lit(as_of)).alias("p")).first()
    assert (row.p.year, row.p.month) == expected


def test_backfill(spark):
    loaded = spark.createDataFrame([(2023, 12), (2023, 12), (2024, 2)], "year int, month int")
    got = periods.backfill_periods(spark, dt.date(2023, 11, 1), dt.date(2024, 5, 31), loaded)
    assert pairs(got) == [(2023, 11), (2024, 1), (2024, 3)]


def test_backfill_before_anything_is_published(spark):
    loaded = spark.createDataFrame([], "year int, month int")
    got = periods.backfill_periods(spark, dt.date(2024, 3, 1), dt.date(2024, 4, 1), loaded)
    assert pairs(got) == []


def test_suite_thresholds():
    limits = suites.DEFAULTS
    assert (limits.bronze_trips.min_bytes, limits.bronze_trips.max_files) == (10_000_000, 5)
    assert (limits.silver_trips.min_bytes, limits.silver_trips.max_files) == (5_000_000, 200)
    assert (limits.silver_weather.min_bytes, limits.silver_weather.max_files) == (1000, 50)
    assert limits.min_rows == 1_000_000
