"""Directories and files of a dataset, from the file system's listing.

Partitions are known by their directory names and files by their status; no contents are
read.  Only the directories of the wanted period are listed.  Directories are found on the
driver; the files in them are a Spark scan, whose listing is a job with a task for each
directory once there are more than ``spark.sql.sources.parallelPartitionDiscovery.threshold``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_SCHEMA = "path string, length bigint, modificationTime timestamp, year int, month int"
MARKER, TEMPORARY, MANIFEST = "_SUCCESS", "_temporary", "_manifest.json"
#: Spark's name for a file of a partitioned write.
_MOVED = re.compile(r"part-\d+-[0-9a-f-]{36}\.c\d{3}\.").match
_FOOTER = int.from_bytes(b"PAR1", "big")


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_folder: bool
    length: int
    modified: int  # milliseconds


@dataclass(frozen=True)
class Folder:
    """A partition directory; ``year`` or ``month`` is None where the name gives no number."""

    path: str
    year: int | None = None
    month: int | None = None

    @property
    def spelled(self) -> str:
        """Partition directories as they are written on storage, such as ``month=03``."""
        return "/".join(p for p in self.path.rstrip("/").split("/") if p.startswith(("year=", "month=")))


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """Contents of one directory by name; none if it does not exist."""
    system, where = _system(spark, path)
    if not system.exists(where):
        return []
    found = [
        Entry(
            s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen(),
            s.getModificationTime(),
        )
        for s in system.listStatus(where)
    ]
    return sorted(found, key=lambda e: e.name)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _system(spark, path)
    system.delete(where, True)


def _value(name: str, key: str) -> tuple[bool, int | None]:
    found, _, text = name.partition("=")
    if found.lower() != key or not _:
        return False, None
    return True, int(text) if text.lstrip("-").isdigit() else None


def folders(
    spark: SparkSession, root: str, year: int | None = None, month: int | None = None
) -> list[Folder]:
    """The dataset's directories ``year=`` and ``year=/month=``, compared as numbers,
    so ``month=3`` and ``month=03`` are the same month.  With ``year`` and ``month`` only
    those of that period are listed."""
    found = []
    for entry in entries(spark, root):
        is_year, y = _value(entry.name, "year")
        if not entry.is_folder or not is_year or (year is not None and y != year):
            continue
        inside = []
        for sub in entries(spark, entry.path):
            is_month, m = _value(sub.name, "month")
            if sub.is_folder and is_month:
                inside.append(Folder(sub.path, y, m))
        if month is None:
            found.append(Folder(entry.path, y))
        found += [f for f in inside if month is None or f.month == month]
    return found


def _is_data(name: str, pattern: str) -> bool:
    """Hidden files, such as markers, are not data."""
    return not name.startswith(("_", ".")) and fnmatch(name, pattern)


def data_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[Entry]:
    """Files right in ``folder``."""
    return [e for e in entries(spark, folder) if not e.is_folder and _is_data(e.name, pattern)]


def holds_data(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> bool:
    """Whether a directory has data files; the listing ends at the first."""
    system, where = _system(spark, folder)
    found = system.listLocatedStatus(where)
    while found.hasNext():
        status = found.next()
        if status.isFile() and _is_data(status.getPath().getName(), pattern):
            return True
    return False


_IN_PARTITION = r"(?i)/year=([^/]*)(?:/month=([^/]*))?/[^/]*$"


def _scan(spark: SparkSession, places: Sequence[Folder], pattern: str, whole: bool = False) -> DataFrame:
    """Files right in directories that hold no other partition directories, one row each;
    ``whole``: in the one directory of a dataset without partitions.

    The scan asks for no contents, so no file is opened.  Files are dealt to tasks by directories:
    left alone, Spark deals them by their bytes, a task for every large file."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", True)  # one that is removed meanwhile is not there
        .option("pathGlobFilter", pattern)
        .load([f.path for f in places])
        .select("path", "length", "modificationTime")
    )
    if whole:
        year = month = F.lit(None).cast("int")
        system, where = _system(spark, places[0].path)
        inside = F.regexp_replace("path", "/[^/]*$", "") == system.makeQualified(where).toString()
    else:
        year, month = (F.regexp_extract("path", _IN_PARTITION, i).try_cast("int") for i in (1, 2))
        inside = F.col("path").rlike(_IN_PARTITION)
    return (
        found.filter(inside & F.col("path").rlike("/[^_./][^/]*$"))
        .withColumns({"year": year, "month": month})
        .coalesce(max(len(places), spark.sparkContext.defaultParallelism))
    )


def list_files(
    spark: SparkSession,
    path: str,
    pattern: str = "*.parquet",
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """One row per file, of the period if one is given: path, length, modificationTime, year, month.

    A file without a byte holds no data, not even Parquet's footer, and is not listed."""
    places = folders(spark, path, year, month)
    above = {f.path.rstrip("/").rpartition("/")[0] for f in places}
    last = [f for f in places if f.path not in above]
    if last:
        out = _scan(spark, last, pattern)
        # Directories above others were listed to find those; their own files are few.
        upper = [f for f in places if f.path in above] + [Folder(path)] * (year is None)
        rows = [
            (e.path, e.length, e.modified, f.year, f.month)
            for f in upper for e in data_files(spark, f.path, pattern) if e.length
        ]
        return out.unionByName(_file_rows(spark, rows)) if rows else out
    system, where = _system(spark, path)
    if year is None and system.exists(where):
        return _scan(spark, [Folder(path)], pattern, whole=True)
    return _file_rows(spark, [])


def _file_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    raw = spark.createDataFrame(rows, FILES_SCHEMA.replace("timestamp", "bigint"))
    return raw.withColumn("modificationTime", F.timestamp_millis("modificationTime"))


def file_inventory(
    spark: SparkSession,
    path: str,
    pattern: str = "*.parquet",
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Per partition: file count, total bytes and newest modification."""
    return list_files(spark, path, pattern, year, month).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("newest"),
    )


def partition_years(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Years with data, one row each; a year's listing ends at its first file."""
    years: dict[int | None, bool] = {}
    for folder in folders(spark, path):
        if not years.get(folder.year) and holds_data(spark, folder.path, pattern):
            years[folder.year] = True
    return spark.createDataFrame([(y,) for y in years], "year int")


def manifest(spark: SparkSession, folder: str) -> dict | None:
    """What landing wrote down about a directory: its files, rows and sources."""
    system, where = _system(spark, f"{folder.rstrip('/')}/{MANIFEST}")
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def is_complete(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> bool:
    """Whether a directory's data may be taken as whole.

    Landing writes down the files of a directory: it is whole while they are there.  A Spark
    write ends with a marker file, in the directory or, if it was partitioned, in the dataset.
    One that replaces single partitions leaves no marker, but moves them there whole, and its
    files have names of their own; other tools leave no marker either.  Such files are taken as
    whole if all end like Parquet files.  What a Spark write into the directory itself left
    without a marker broke off, and so did one whose temporary directory is there."""
    found = entries(spark, folder)
    names = {e.name for e in found}
    files = [e for e in found if not e.is_folder and _is_data(e.name, pattern)]
    if not files or TEMPORARY in names:
        return False
    if MANIFEST in names:
        known = {(f["name"], f["length"]) for f in manifest(spark, folder)["files"]}
        return known <= {(e.name, e.length) for e in files}
    if MARKER in names or _marked_above(spark, folder):
        return True
    return all((not e.name.startswith("part-") or _MOVED(e.name)) and _ends_whole(spark, e) for e in files)


def _marked_above(spark: SparkSession, folder: str) -> bool:
    """Whether a directory that holds this one as a partition has the marker of a write."""
    parent, _, name = folder.rstrip("/").rpartition("/")
    while name.startswith(("year=", "month=")):
        system, where = _system(spark, f"{parent}/{MARKER}")
        if system.exists(where):
            return True
        parent, _, name = parent.rpartition("/")
    return False


def _ends_whole(spark: SparkSession, file: Entry) -> bool:
    if not file.name.endswith(".parquet"):
        return True
    if file.length < 12:
        return False
    system, where = _system(spark, file.path)
    stream = system.open(where)
    try:
        stream.seek(file.length - 4)
        return stream.readInt() == _FOOTER
    finally:
        stream.close()


def complete_folders(
    spark: SparkSession,
    path: str,
    pattern: str = "*.parquet",
    year: int | None = None,
    month: int | None = None,
) -> list[Folder]:
    return [f for f in folders(spark, path, year, month) if is_complete(spark, f.path, pattern)]


def loaded_periods(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(year, month) that hold complete data, see ``is_complete``."""
    found = {(f.year, f.month) for f in complete_folders(spark, path, pattern)}
    return spark.createDataFrame(sorted(found, key=str), "year int, month int")
