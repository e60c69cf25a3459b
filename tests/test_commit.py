"""Landing that commits, what a broken run leaves, and the ledger."""

import os

import pytest
from pyspark.sql import functions as F

from lodestrata.sources import commit
from lodestrata.sources.commit import Place, changed, footer_rows, ledger, recover, recover_all
from lodestrata.sources.inventory import data_files, is_complete, loaded_periods
from lodestrata.sources.lake import read_partition, write_partitions
from tests.test_months import land, put, values


class Broken(BaseException):
    """The process ends: nothing is undone."""


@pytest.fixture
def landed(spark, scratch):
    """A month of rows 1 to 3, and a landing file that now has 4 and 5."""
    put(scratch + "/landing/t1_2024-03.parquet", {"id": [1, 2, 3]})
    assert land(spark, scratch, [(2024, 3)])[0]["success"]
    put(scratch + "/landing/t1_2024-03.parquet", {"id": [4, 5]})
    return scratch


def ids(spark, root):
    return [v for (v,) in values(read_partition(spark, root + "/bronze", 2024, 3), "id")]


def again(spark, root):
    return land(spark, root, [(2024, 3)], skip_existing=False)[0]


def left(root):
    """What is in the staging directory."""
    return [n for _, d, f in os.walk(root + "/bronze/_landing") for n in d + f if not n.endswith(".crc") and not n.startswith("year-")]


def test_a_damaged_source_leaves_the_old_month(spark, landed):
    path = landed + "/landing/t1_2024-03.parquet"
    put(path, {"id": list(range(200_000))})
    with open(path, "r+b") as f:
        f.seek(4)
        f.write(b"\xff" * 5000)
    outcome = again(spark, landed)
    assert not outcome["success"] and outcome["error"]
    assert ids(spark, landed) == [1, 2, 3] and left(landed) == []
    assert is_complete(spark, outcome["path"])


def test_rows_that_get_lost_are_noticed(spark, landed, monkeypatch):
    real = commit.footer_rows
    counted = []

    def one_more(spark, paths):
        found = real(spark, paths)
        if not counted:
            found[paths[0]] += 1
        counted.append(1)
        return found

    monkeypatch.setattr("lodestrata.sources.lake.footer_rows", one_more)
    outcome = again(spark, landed)
    assert not outcome["success"] and "2 rows written of 3" in outcome["error"]
    assert ids(spark, landed) == [1, 2, 3] and left(landed) == []


@pytest.mark.parametrize("step", ["write_json", "rename"])
@pytest.mark.parametrize("call", [1, 2])
def test_a_step_that_fails(spark, landed, monkeypatch, step, call):
    real, calls = getattr(commit, step), []

    def failing(*args):
        calls.append(args)
        if len(calls) == call:
            raise OSError("the store is away")
        return real(*args)

    monkeypatch.setattr(commit, step, failing)
    outcome = again(spark, landed)
    assert not outcome["success"] and "the store is away" in outcome["error"]
    assert ids(spark, landed) == [1, 2, 3] and left(landed) == []
    monkeypatch.undo()
    assert again(spark, landed)["rows"] == 2 and ids(spark, landed) == [4, 5]


@pytest.mark.parametrize("step,call,rows", [
    ("write_json", 1, [1, 2, 3]),  # before the record: the old month
    ("write_json", 2, [1, 2, 3]),
    ("rename", 1, [4, 5]),  # after it: the new one
    ("rename", 2, [4, 5]),
    ("remove", 1, [4, 5]),
    ("remove", 2, [4, 5]),
])
def test_a_run_that_ends_at_a_step(spark, landed, monkeypatch, step, call, rows):
    real, calls = getattr(commit, step), []

    def ending(*args):
        calls.append(args)
        if len(calls) == call:
            raise Broken
        return real(*args)

    monkeypatch.setattr(commit, step, ending)
    with pytest.raises(Broken):
        again(spark, landed)
    monkeypatch.undo()
    recover(spark, landed + "/bronze", landed + "/bronze/year=2024/month=3")
    assert ids(spark, landed) == rows and left(landed) == []
    assert again(spark, landed)["success"] and ids(spark, landed) == [4, 5]


def test_recovery_of_a_whole_dataset(spark, landed, monkeypatch):
    real, calls = commit.rename, []

    def ending(*args):
        calls.append(args)
        if len(calls) == 2:
            raise Broken
        return real(*args)

    monkeypatch.setattr(commit, "rename", ending)
    with pytest.raises(Broken):
        again(spark, landed)
    monkeypatch.undo()
    os.makedirs(landed + "/bronze/_landing/year-2024.month-4/new-x")
    recover_all(spark, landed + "/bronze")
    assert ids(spark, landed) == [4, 5] and left(landed) == ["new-x"]


def test_spellings_are_replaced_together(spark, scratch):
    put(scratch + "/landing/t1_2024-03.parquet", {"id": [1]})
    for spelled in ("month=03", "month=3"):
        put(f"{scratch}/bronze/year=2024/{spelled}/part-0.parquet", {"id": [9]})
    assert Place.of("/r", "/r/year=2024/month=03/").staging == Place.of("/r/", "/r/year=2024/month=3").staging
    assert land(spark, scratch, [(2024, 3)])[0]["success"]
    assert len(os.listdir(scratch + "/bronze/year=2024")) == 1 and ids(spark, scratch) == [1]


# --- the ledger ---------------------------------------------------------------------------


def test_only_the_month_whose_source_changed_is_landed_again(spark, scratch):
    for m in (1, 2, 3):
        put(f"{scratch}/landing/t1_2024-0{m}.parquet", {"id": [m] * m})
    months = [(2024, m) for m in (1, 2, 3)]
    assert [o["skipped"] for o in land(spark, scratch, months)] == [False] * 3
    assert [o["skipped"] for o in land(spark, scratch, months)] == [True] * 3
    put(f"{scratch}/landing/t1_2024-02.parquet", {"id": [7, 8, 9]})
    assert [(o["skipped"], o["rows"]) for o in land(spark, scratch, months)] == [(True, None), (False, 3), (True, None)]
    put(f"{scratch}/landing/t2_2024-03.parquet", {"id": [5]})
    assert [o["skipped"] for o in land(spark, scratch, months)] == [True, True, False]
    # Sources that are gone leave the month.
    os.remove(f"{scratch}/landing/t1_2024-01.parquet")
    assert land(spark, scratch, [(2024, 1)])[0]["skipped"]
    rows = ledger(spark, scratch + "/bronze").orderBy("month").collect()
    assert [(r.month, r.rows) for r in rows] == [(1, 1), (2, 3), (3, 4)]
    assert sorted((s.name, s.rows) for s in rows[2].sources) == [("t1_2024-03.parquet", 3), ("t2_2024-03.parquet", 1)]
    assert rows[0].sources[0].length > 0 and rows[0].sources[0].modified > 0


def test_months_of_a_partitioned_write(spark, scratch):
    rows = spark.range(40).select("id", F.lit(2024).alias("year"), (F.col("id") % 2 + 1).alias("month"))
    write_partitions(rows, scratch + "/bronze", ["year", "month"])
    assert values(loaded_periods(spark, scratch + "/bronze"), "year", "month") == [(2024, 1), (2024, 2)]
    put(scratch + "/landing/t1_2024-01.parquet", {"id": [1]})
    assert land(spark, scratch, [(2024, 1)])[0]["skipped"]
    # The marker of the dataset, where the write leaves one.
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year", "month").parquet(scratch + "/whole")
    assert values(loaded_periods(spark, scratch + "/whole"), "year", "month") == [(2024, 1), (2024, 2)]
    # A write into the month that broke off.
    os.makedirs(scratch + "/bronze/year=2024/month=2/_temporary/0")
    assert values(loaded_periods(spark, scratch + "/bronze"), "year", "month") == [(2024, 1)]


def test_a_landed_file_that_is_gone_or_cut(spark, landed):
    folder = landed + "/bronze/year=2024/month=3"
    (file,) = data_files(spark, folder)
    os.remove(folder + "/_SUCCESS")
    assert is_complete(spark, folder)
    with open(folder + "/" + file.name, "r+b") as f:
        f.truncate(50)
    assert not is_complete(spark, folder)
    assert land(spark, landed, [(2024, 3)])[0]["rows"] == 2


def test_rows_from_footers(spark, scratch):
    put(scratch + "/a.parquet", {"x": [1, 2]})
    put(scratch + "/b c.parquet", {"y": ["z"]})
    put(scratch + "/none.parquet", {"x": []})
    paths = [e.path for e in data_files(spark, scratch)]
    assert sorted(footer_rows(spark, paths).values()) == [0, 1, 2]
    assert footer_rows(spark, []) == {}
    assert not changed(spark, scratch, data_files(spark, scratch))
