"""Replacing a partition directory as a whole, and the ledger of what it was made from.

New files are written to a staging directory of the dataset, which readers do not see, and
their rows are held against the sources'.  A commit record then names the swap: the old
directory is moved aside, the new one to its place, and the record goes before the old files do.  A run
that breaks off before the record leaves the old directory as it was; one that breaks off
after it is finished by the next, see ``recover``.  Moves are renames: on stores that copy instead,
they take longer, and the record makes them repeatable.

One run at a time may land a period.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestrata.sources.inventory import (
    MANIFEST,
    Entry,
    _system,
    data_files,
    entries,
    folders,
    remove,
)
from lodestrata.sources.inventory import manifest as read_manifest

STAGING = "_landing"
RECORD = "commit.json"


class RowsLost(Exception):
    """What was written has not the rows of its sources."""


@dataclass(frozen=True)
class Place:
    """A partition directory and where its replacement is prepared."""

    target: str
    staging: str

    @classmethod
    def of(cls, root: str, target: str) -> Place:
        root, target = root.rstrip("/"), target.rstrip("/")
        # Partition directories compare as numbers, so the staging directory does as well.
        parts = [p.partition("=") for p in target.split("/") if p.startswith(("year=", "month="))]
        key = ".".join(f"{k}-{int(v) if v.lstrip('-').isdigit() else v}" for k, _, v in parts)
        return cls(target, f"{root}/{STAGING}/{key or 'whole'}")

    @property
    def record(self) -> str:
        return f"{self.staging}/{RECORD}"

    @property
    def aside(self) -> str:
        return f"{self.staging}/old"


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path)
    return system.exists(where)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a directory to a name that is free."""
    system, where = _system(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if system.exists(to):
        raise FileExistsError(target)
    system.mkdirs(to.getParent())
    if not system.rename(where, to):
        raise OSError(f"{source} could not be moved to {target}")


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """The file is there whole or not at all."""
    system, where = _system(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = system.create(temporary, True)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    system.delete(where, False)
    if not system.rename(temporary, where):
        raise OSError(f"{path} could not be written")


def read_json(spark: SparkSession, path: str) -> dict:
    system, where = _system(spark, path)
    stream = system.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def footer_rows(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """Rows of each Parquet file of a directory, from the footers in one job."""
    if not paths:
        return {}
    rows = spark.read.schema(StructType([])).parquet(*paths)
    counted = rows.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    found = {unquote(r["name"]): r["n"] for r in counted.collect()}
    return {p: found.get(p.rsplit("/", 1)[-1], 0) for p in paths}


def total_rows(spark: SparkSession, paths: Sequence[str]) -> int:
    """Rows of Parquet files, from the footers in one job."""
    return spark.read.schema(StructType([])).parquet(*paths).count() if paths else 0


def described(files: Sequence[Entry], rows: dict[str, int] | None = None) -> list[dict]:
    """Sources as the ledger keeps them."""
    return [
        {"name": e.name, "length": e.length, "modified": e.modified, "rows": (rows or {}).get(e.path)}
        for e in files
    ]


@dataclass(frozen=True)
class Staged:
    """What is to take the place of a directory: ``new``, below ``base`` as the partition is below its dataset."""

    place: Place
    base: str
    new: str
    rows: int
    others: Sequence[str] = ()


def stage_folder(
    spark: SparkSession,
    root: str,
    target: str,
    write: Callable[[str], None],
    sources: Sequence[dict] = (),
    expected: int | None = None,
    others: Sequence[str] = (),
) -> Staged:
    """Have ``write`` write to a path that readers of the dataset do not see; then ``publish`` or
    ``discard`` it.  ``expected``: the rows it must have, if known.  ``others``: directories that the
    new one replaces as well."""
    place = Place.of(root, target)
    recover(spark, root, target)
    base = f"{place.staging}/new-{uuid.uuid4().hex}"
    period = [p for p in place.target.split("/") if p.startswith(("year=", "month="))]
    staged = Staged(place, base, "/".join([base, *period]), 0, tuple(others))
    try:
        write(staged.new)
        below = [f.path for f in folders(spark, base)] or [base]
        files = [e for path in below for e in data_files(spark, path)]
        rows = total_rows(spark, [e.path for e in files])
        if expected is not None and rows != expected:
            raise RowsLost(f"{rows} rows written of {expected}")
        own = [{"name": e.name, "length": e.length} for e in data_files(spark, staged.new)]
        write_json(spark, f"{staged.new}/{MANIFEST}", {"sources": list(sources), "rows": rows, "files": own})
    except Exception:
        remove(spark, place.staging)
        raise
    return replace(staged, rows=rows)


def publish(spark: SparkSession, staged: Staged) -> int:
    """Put it in its place; returns its rows.  If that fails, the place holds what it held before."""
    place = staged.place
    try:
        write_json(
            spark, place.record, {"new": staged.new, "target": place.target, "others": list(staged.others)}
        )
    except Exception:
        discard(spark, staged)
        raise
    try:
        _swap(spark, place)
    except Exception:
        _undo(spark, place)
        raise
    return staged.rows


def discard(spark: SparkSession, staged: Staged) -> None:
    remove(spark, staged.place.staging)


def replace_folder(
    spark: SparkSession,
    root: str,
    target: str,
    write: Callable[[str], None],
    sources: Sequence[dict],
    expected: int | None = None,
    others: Sequence[str] = (),
) -> int:
    """Put what ``write`` writes to a path in the place of ``target``, see ``stage_folder``; returns
    its rows.  If anything fails, ``target`` holds what it held before."""
    return publish(spark, stage_folder(spark, root, target, write, sources, expected, others))


def _swap(spark: SparkSession, place: Place) -> None:
    """Finish the swap of the commit record, from wherever it broke off."""
    record = read_json(spark, place.record)
    if exists(spark, record["new"]):
        if exists(spark, record["target"]) and not exists(spark, place.aside):
            rename(spark, record["target"], place.aside)
        rename(spark, record["new"], record["target"])
    for path in record["others"]:
        remove(spark, path)
    remove(spark, place.record)
    remove(spark, place.staging)


def _undo(spark: SparkSession, place: Place) -> None:
    """Back to the old directory, if the new one has not come to its place.  Does what can be done; what
    cannot is left to ``recover``."""
    if not exists(spark, place.record):
        return
    record = read_json(spark, place.record)
    if not exists(spark, record["new"]):
        return  # the new one is in place; only cleaning up is left
    if exists(spark, place.aside) and not exists(spark, record["target"]):
        rename(spark, place.aside, record["target"])
    remove(spark, place.staging)


def recover(spark: SparkSession, root: str, target: str) -> None:
    """Finish a swap that was recorded, and drop what was staged without a record."""
    place = Place.of(root, target)
    if not exists(spark, place.staging):
        return
    if exists(spark, place.record):
        _swap(spark, place)
        return
    if exists(spark, place.aside) and not exists(spark, place.target):
        rename(spark, place.aside, place.target)
    remove(spark, place.staging)


def recover_all(spark: SparkSession, root: str) -> None:
    """Finish every swap of a dataset that was recorded.  Staged files without a record are left: another
    run may be writing them."""
    for e in entries(spark, f"{root.rstrip('/')}/{STAGING}"):
        record = f"{e.path}/{RECORD}"
        if exists(spark, record):
            _swap(spark, Place(read_json(spark, record)["target"], e.path))


def changed(spark: SparkSession, folder: str, files: Sequence[Entry]) -> bool:
    """Whether a directory was made from other files than these; unknown counts as no,
    and so does that no source is there any more."""
    known = read_manifest(spark, folder)
    if known is None or not files:
        return False

    def key(name: str, length: int, modified: int) -> tuple:
        return name, length, modified

    before = {key(s["name"], s["length"], s["modified"]) for s in known["sources"]}
    return before != {key(e.name, e.length, e.modified) for e in files}


LEDGER_SCHEMA = (
    "year int, month int, path string, rows bigint, "
    "sources array<struct<name: string, length: bigint, modified: bigint, rows: bigint>>"
)


def ledger(spark: SparkSession, root: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """A row for each directory with a manifest: its period, rows, and the sources it was made from."""
    rows = []
    for folder in folders(spark, root, year, month):
        known = read_manifest(spark, folder.path)
        if known is not None:
            sources = [(s["name"], s["length"], s["modified"], s["rows"]) for s in known["sources"]]
            rows.append((folder.year, folder.month, folder.path, known["rows"], sources))
    return spark.createDataFrame(rows, LEDGER_SCHEMA)
