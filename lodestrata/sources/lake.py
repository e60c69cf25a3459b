"""Layout of the lake, readers, and writers that replace whole partitions."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lodestrata.operators.rules import in_period
from lodestrata.sources.commit import (
    Staged,
    changed,
    described,
    footer_rows,
    publish,
    recover,
    replace_folder,
    stage_folder,
)
from lodestrata.sources.inventory import (
    Entry,
    Folder,
    data_files,
    entries,
    folders,
    is_complete,
    remove,
)
from lodestrata.sources.schemas import SchemaConflict, as_schema, drifts, merged

LAYERS = ("bronze", "silver", "gold")
PERIOD = ("year", "month")
#: Bytes of raw files that go into one landed file.
TARGET_FILE_BYTES = 256 * 1024 * 1024
#: Table properties with the fingerprint of a registered partition's files.
_MARK = "lodestrata.files."
#: Properties of a view with the table that holds a directory.
_HOME = "lodestrata.home."


@dataclass(frozen=True)
class Lake:
    """Root path and database names; ``databases`` maps a layer to its database."""

    root: str
    databases: Mapping[str, str] | None = None

    def path(
        self,
        layer: str,
        source: str,
        dataset: str,
        year: int | None = None,
        month: int | None = None,
    ) -> str:
        parts = [self.root.rstrip("/"), layer, source, dataset]
        if year is not None:
            parts.append(f"year={year}")
            if month is not None:
                parts.append(f"month={month}")
        return "/".join(parts) + "/"

    def database(self, layer: str) -> str:
        return (self.databases or {}).get(layer, layer)

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def create_layers(self, spark: SparkSession) -> None:
        for layer in LAYERS:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}")


# --- readers --------------------------------------------------------------------


def read_partition(
    spark: SparkSession, root: str, year: int, month: int | None = None, on: str | None = None
) -> DataFrame:
    """One period of a Parquet dataset.

    Where the dataset has directories ``year=/month=``, only the period's are opened, and
    their schemas are merged: columns by name without regard to case, types widened.  For
    data without them ``on`` names the date column, whose range is pushed into the scan."""
    found = [f for f in folders(spark, root, year, month) if data_files(spark, f.path)]
    if not found:
        return in_period(spark.read.parquet(root), year, month, on)
    return in_period(read_folders(spark, root, found), year, month, on)


def read_folders(spark: SparkSession, root: str, found: Sequence[Folder]) -> DataFrame:
    """Partition directories of a dataset as one frame with ``year`` and ``month``."""
    groups = schema_groups(spark, found)
    schemas = [g.schema for g in groups]
    whole = merged(schemas, widen=True)
    if not any(drifts(schema, whole) for schema in schemas):
        reader = spark.read.schema(whole).option("basePath", root)
        return reader.parquet(*(f.path for f in found))
    keys = ["year"] + ["month"] * any(f.month is not None for f in found)
    out = None
    for group in groups:
        # A file takes its period from its directory, directories from their names.
        months = [[f for f in group.folders if f.month is not None], [f for f in group.folders if f.month is None]]
        for alike in filter(None, months):
            reader = spark.read.schema(group.schema)
            if group.files:
                part = reader.parquet(*group.files).withColumns({k: F.lit(getattr(alike[0], k)) for k in keys})
            else:
                part = reader.option("basePath", root).parquet(*(f.path for f in alike))
            part = as_schema(part, StructType([*whole, *(StructField(k, IntegerType()) for k in keys)]))
            out = part if out is None else out.unionByName(part)
    return out


@dataclass(frozen=True)
class SchemaGroup:
    """Directories whose files agree in types.  A directory whose own files do not agree makes several
    groups, each with its ``files``."""

    schema: StructType
    folders: Sequence[Folder]
    files: Sequence[str] = ()


def schema_groups(spark: SparkSession, found: Sequence[Folder]) -> list[SchemaGroup]:
    """Directories by schema.  One job reads the footers of all; only where types drift are the
    directories halved until those of each part agree, which takes a few jobs for a drift, as months next
    to each other mostly agree.  Parts that agree are put together again."""

    def split(part: Sequence[Folder]) -> list[SchemaGroup]:
        schema = _merged_footers(spark, [f.path for f in part])
        if schema is not None:
            return [SchemaGroup(schema, part)]
        if len(part) > 1:
            half = len(part) // 2
            return split(part[:half]) + split(part[half:])
        files = [e.path for e in data_files(spark, part[0].path)]
        return [SchemaGroup(schema, part, paths) for schema, paths in _file_schemas(spark, files)]

    def order(folder: Folder) -> tuple:
        return tuple(-1 if v is None else v for v in (folder.year, folder.month))

    out: list[SchemaGroup] = []
    for group in split(sorted(found, key=order)) if found else []:
        for i, known in enumerate(out):
            whole = None if group.files or known.files else _agreed(known.schema, group.schema)
            if whole is not None:
                out[i] = SchemaGroup(whole, [*known.folders, *group.folders])
                break
        else:
            out.append(group)
    return out


def _agreed(a: StructType, b: StructType) -> StructType | None:
    try:
        return merged([a, b])
    except SchemaConflict:
        return None


def _merged_footers(spark: SparkSession, paths: Sequence[str]) -> StructType | None:
    """The schema of all files of directories, from one job; None if they do not agree."""
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
    try:
        return merged([reader.parquet(*paths).schema])
    except Exception as failure:
        if "CANNOT_MERGE" not in str(failure) and "Failed to merge" not in str(failure):
            raise
    return None


def _file_schemas(spark: SparkSession, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    groups: list[tuple[StructType, list[str]]] = []
    for path in paths:
        schema = spark.read.parquet(path).schema
        same = next((files for known, files in groups if known == schema), None)
        if same is None:
            groups.append((schema, [path]))
        else:
            same.append(path)
    return groups


def read_observations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Hourly observation CSV, every column as text; quotes are doubled inside quotes."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_features(
    spark: SparkSession,
    table: str,
    year: int,
    month: int,
    columns: Sequence[str] = ("*",),
    where: str | None = None,
    order_by: str = "pickup_date",
) -> DataFrame:
    """A period of a feature table, in date order."""
    return select_features(spark.table(table), year, month, columns, where, order_by)


def select_features(
    features: DataFrame,
    year: int,
    month: int,
    columns: Sequence[str] = ("*",),
    where: str | None = None,
    order_by: str = "pickup_date",
) -> DataFrame:
    rows = in_period(features, year, month)
    if where is not None:
        rows = rows.filter(where)
    return rows.orderBy(order_by).select(*columns)


# --- writers --------------------------------------------------------------------


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``; keep the others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def overwrite_partitions(
    df: DataFrame,
    table: str,
    path: str,
    by: Sequence[str] = PERIOD,
    scope: Mapping[str, int] | None = None,
) -> int:
    """Write a cleaned or feature table; returns the rows written.

    Partitions that occur in ``df`` are replaced, columns the table lacks are
    added.  ``scope`` is the part of the table this run owns, such as
    ``{"year": 2024, "month": 3}``: partitions in it that the run did not write
    hold rows of an earlier run and are emptied.

    The number of files follows from the bytes: rows are dealt by partition into pieces
    of the session's advisory size.  A partition that is there under another spelling,
    ``month=03`` for ``month=3``, is replaced as well.

    Row count and written partitions are observed in the writing tasks, which
    count once however often they are tried.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        df = _as_stored(spark, df, table)
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.struct(*by)).alias("partitions"),
    ).hint("rebalance", *by)
    if exists:
        _dynamic(spark, lambda: observed.write.insertInto(table, overwrite=True))
    else:
        _dynamic(
            spark,
            lambda: observed.write.mode("overwrite")
            .partitionBy(*by)
            .option("path", path)
            .format("parquet")
            .saveAsTable(table),
        )
    rows, partitions = _written(seen.get, df, by)
    _drop_replaced(spark, table, by, scope, partitions)
    return rows


@dataclass(frozen=True)
class StagedPeriod:
    """A period of a table that is written but not yet part of it."""

    table: str
    root: str
    scope: Mapping[str, int]
    columns: StructType
    staged: Staged

    @property
    def rows(self) -> int:
        return self.staged.rows

    @property
    def base(self) -> str:
        """A dataset of this period alone, laid out as the table."""
        return self.staged.base

    def frame(self, spark: SparkSession) -> DataFrame:
        """The table as it will be: the staged period, and the published rows of all others."""
        keys = StructType([StructField(k, IntegerType()) for k in PERIOD])
        schema = StructType([*self.columns, *keys])
        if self.rows:
            new = spark.read.schema(schema).parquet(self.base)
        else:
            new = spark.createDataFrame([], schema)
        if not spark.catalog.tableExists(self.table):
            return new
        own = F.lit(True)
        for key, value in self.scope.items():
            own = own & (F.col(key) == value)
        return new.unionByName(spark.table(self.table).filter(~own), allowMissingColumns=True)


def stage_period(df: DataFrame, table: str, path: str, scope: Mapping[str, int]) -> StagedPeriod:
    """Write the rows of a month, or with ``scope`` of a year alone of all its months, of a cleaned or feature
    table where its readers do not see them.  ``publish_period`` then puts them in the place of
    the period's partitions; until then, and if anything fails, the table is as it was.

    Columns as ``overwrite_partitions`` has them.  A row outside the period is an error."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = _as_stored(spark, df, table)
    spelled = "/".join(f"{k}={v}" for k, v in scope.items())
    there = [f for f in folders(spark, path, **scope) if "month" in scope or f.month is None]
    outside = F.lit(False)
    for key, value in scope.items():
        outside = outside | ~F.col(key).eqNullSafe(value)
    inner = [k for k in PERIOD if k not in scope]
    stray = F.raise_error(F.lit(f"a row outside {dict(scope)}")).cast("boolean")
    rows = df.filter(F.when(outside, stray).otherwise(True)).drop(*scope).hint("rebalance", *inner)
    staged = stage_folder(
        spark,
        path,
        f"{path.rstrip('/')}/{spelled}",
        lambda to: (rows.write.partitionBy(*inner) if inner else rows.write).parquet(to),
        others=[f.path for f in there if f.spelled != spelled],
    )
    columns = StructType([f for f in df.schema if f.name not in PERIOD])
    return StagedPeriod(table, path, dict(scope), columns, staged)


def publish_period(spark: SparkSession, period: StagedPeriod) -> int:
    """Make a staged period part of its table, creating it if need be; returns the rows."""
    publish(spark, period.staged)
    if not period.rows:
        remove(spark, period.staged.place.target)
    table, scope = period.table, period.scope
    if not spark.catalog.tableExists(table):
        _external_table(spark, table, period.root, period.columns, PERIOD)
        spark.sql(f"MSCK REPAIR TABLE {table}")
    there = {
        (f.year, f.month): f.path for f in folders(spark, period.root, **scope) if f.month is not None
    }
    known = ", ".join(f"{k} = {v}" for k, v in scope.items())
    listed = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table} PARTITION ({known})").collect()]
    for name in listed:
        if tuple(_number(p.partition("=")[2]) for p in name.split("/")) not in there:
            _drop_partition(spark, table, name)
    if any(name != "/".join(f"{k}={_number(v)}" for k, _, v in (p.partition("=") for p in name.split("/"))) for name in listed):
        # Under another spelling, such as month=03, only a repair takes a partition out.
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    for (year, month), path in there.items():
        spec = f"year = {year}, month = {month}"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return period.rows


def _number(value: object) -> object:
    """Partition values compare as numbers where they are numbers."""
    text = str(value)
    return int(text) if text.lstrip("-").isdigit() else text


def _written(metrics: dict, df: DataFrame, by: Sequence[str]) -> tuple[int, set[tuple]]:
    """Rows and partitions of a write.  Should the observation have been lost,
    they are taken from the frame, so that nothing just written passes for stale."""
    if "rows" in metrics:
        rows, partitions = metrics["rows"], metrics["partitions"]
    else:
        counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).collect()
        rows, partitions = sum(r["rows"] for r in counted), counted
    return rows, {tuple(_number(p[c]) for c in by) for p in partitions}


def _dynamic(spark: SparkSession, write) -> None:
    """Run a table write that replaces only the partitions it contains."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        write()
    finally:
        spark.conf.set(key, before)


def _as_stored(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Columns in the table's order and types; new ones are added to the table
    first, ones the frame lacks are null."""
    known = {name.lower() for name in spark.table(table).columns}
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    have = {name.lower() for name in df.columns}
    return df.select(
        *(
            (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in spark.table(table).schema
        )
    )


def _drop_replaced(
    spark: SparkSession,
    table: str,
    by: Sequence[str],
    scope: Mapping[str, int] | None,
    written: set[tuple],
) -> None:
    """Remove partitions that this write replaced or, in ``scope``, should have.

    Only directories below the leading part of ``scope``, or below the first keys that
    were written, are listed."""
    location = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    if location is None:
        return
    first = {w[0] for w in written} | ({_number(scope[by[0]])} if scope and by[0] in scope else set())
    whole = bool(scope) and by[0] not in scope
    gone = []
    for values, path in _partition_folders(spark, location[1], by, None if whole else first):
        numbers = tuple(_number(v) for v in values)
        owned = bool(scope) and all(dict(zip(by, numbers))[c] == _number(v) for c, v in scope.items())
        other_spelling = values != tuple(str(n) for n in numbers)
        if (numbers in written and other_spelling) or (owned and numbers not in written):
            gone.append(path)
    for path in gone:
        remove(spark, path)
    if gone:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)


def _partition_folders(
    spark: SparkSession, root: str, by: Sequence[str], first: set | None
) -> list[tuple[tuple[str, ...], str]]:
    """(values as spelled, path) of the partition directories; of the first key only
    ``first``."""
    level: list[tuple[tuple[str, ...], str]] = [((), root)]
    for key in by:
        below = []
        for values, path in level:
            for e in entries(spark, path):
                name, _, value = e.name.partition("=")
                if e.is_folder and name == key and (values or first is None or _number(value) in first):
                    below.append(((*values, value), e.path))
        level = below
    return level


def register_external(spark: SparkSession, table: str, path: str) -> None:
    """Make a raw dataset readable by name; later calls add new partitions and columns
    and never drop any.

    It is a table as long as every column has one type in all partitions.  Where a type
    drifts between months, files of either type cannot be read as one table: it becomes a view over
    a table for each set of types, ``<table>__types<n>``, that widens the columns, and shows the directories
    that are there.  Only directories are opened that are not known yet, or whose files are others
    than when they were opened; one job reads the footers of all of them, see ``schema_groups``."""
    listed = [(f, data_files(spark, f.path)) for f in folders(spark, path)]
    found = [f for f, files in listed if files] or [Folder(path)]
    marks = {_MARK + f.spelled: _fingerprint(files) for f, files in listed if files}
    exists = spark.catalog.tableExists(table)
    if exists and spark.catalog.getTable(table).tableType == "VIEW":
        _as_view(spark, table, path, found, marks)
        return
    if exists:
        partitioned = any(c.isPartition for c in spark.catalog.listColumns(table))
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} if partitioned else set()
        seen = _properties(spark, table)
        marks = {k: v for k, v in marks.items() if seen.get(k) != v}
        fresh = [f for f in found if f.spelled not in known or _MARK + f.spelled in marks]
        columns = StructType([f for f in spark.table(table).schema if f.name not in PERIOD or not partitioned])
    else:
        fresh, columns = found, StructType([])
    groups = schema_groups(spark, fresh)
    whole = merged([columns, *(g.schema for g in groups)], widen=True)
    if drifts(columns, whole) or any(drifts(g.schema, whole) for g in groups):
        if exists:
            spark.sql(f"DROP TABLE {table}")  # external: the files stay
        marks = {_MARK + f.spelled: _fingerprint(files) for f, files in listed if files}
        _as_view(spark, table, path, found, marks)
        return
    if not exists:
        _external_table(spark, table, path, whole, [k for k in PERIOD if any(getattr(f, k) is not None for f in found)])
    else:
        _add_columns(spark, table, columns, whole)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table}")
    if marks:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in marks.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
    spark.catalog.refreshTable(table)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _external_table(spark: SparkSession, table: str, path: str, columns: StructType, keys: Sequence[str]) -> None:
    types = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in columns] + [f"{k} int" for k in keys])
    dealt = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
    spark.sql(f"CREATE TABLE {table} ({types}) USING parquet {dealt} LOCATION '{path}'")


def _add_columns(spark: SparkSession, table: str, columns: StructType, whole: StructType) -> None:
    have = {f.name.lower() for f in columns}
    new = [f for f in whole if f.name.lower() not in have]
    if new:
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({types})")


def _fingerprint(files: Sequence[Entry]) -> str:
    """Changes with the names, lengths or modification times of files."""
    return hashlib.sha256(repr([(e.name, e.length, e.modified) for e in files]).encode()).hexdigest()[:32]


def _as_view(
    spark: SparkSession, table: str, path: str, found: Sequence[Folder], marks: Mapping[str, str]
) -> None:
    """A view over a table for each set of types.  Which directory is in which is kept in the view's properties,
    so directories that have not changed are not opened again."""
    seen = _properties(spark, table) if spark.catalog.tableExists(table) else {}
    home = {f.spelled: seen.get(_HOME + f.spelled) for f in found if seen.get(_MARK + f.spelled) == marks.get(_MARK + f.spelled)}
    fresh = [f for f in found if not home.get(f.spelled)]
    branches = {name: _own_columns(spark, name) for name in sorted({v for k, v in seen.items() if k.startswith(_HOME)})}
    # What has changed or gone leaves its table.
    for key, name in seen.items():
        if key.startswith(_HOME) and not home.get(key.removeprefix(_HOME)) and branches[name][1]:
            _drop_partition(spark, name, key.removeprefix(_HOME))
    loose: list[tuple[StructType, Folder, str]] = []
    taken = {(n, _period(f)) for f in found if (n := home.get(f.spelled))}
    for group in schema_groups(spark, fresh):
        if group.files:
            loose += [(group.schema, group.folders[0], p) for p in group.files]
            continue
        for folder in group.folders:
            name = next(
                (
                    n for n, (columns, keys) in branches.items()
                    if keys == _keys(folder) and (n, _period(folder)) not in taken and _agreed(columns, group.schema)
                ),
                None,
            )
            if name is None:
                number = 1 + max((int(n.rpartition("__types")[2]) for n in branches), default=0)
                name = f"{table}__types{number}"
                if spark.catalog.tableExists(name):
                    spark.sql(f"DROP TABLE {name}")  # of an earlier view; the files stay
                _external_table(spark, name, path if _keys(folder) else folder.path, group.schema, _keys(folder))
                branches[name] = (group.schema, _keys(folder))
            columns, keys = branches[name]
            both = _agreed(columns, group.schema)
            if len(both) > len(columns):
                _add_columns(spark, name, columns, both)
                branches[name] = (both, keys)
            if keys:
                spec = ", ".join(f"{k} = {getattr(folder, k)}" for k in keys)
                # A call that broke off may have left it.
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
                spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION '{folder.path}'")
            home[folder.spelled] = name
            taken.add((name, _period(folder)))
    used = {n: c for n, c in branches.items() if n in home.values()}
    whole = merged([*(columns for columns, _ in used.values()), *(schema for schema, _, _ in loose)], widen=True)
    for name in used:
        spark.catalog.refreshTable(name)
    shown = [k for k in PERIOD if any(getattr(f, k) is not None for f in found)]
    parts = [
        _widening(name, columns, whole, {k: k if k in keys else "NULL" for k in shown})
        for name, (columns, keys) in used.items()
    ]
    for schema, folder, file in loose:
        period = {k: "NULL" if getattr(folder, k) is None else str(getattr(folder, k)) for k in shown}
        parts.append(_widening(f"parquet.`{file}`", schema, whole, period))
    kept = {**marks, **{_HOME + k: v for k, v in home.items()}}
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in kept.items() if v)
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({pairs}) AS {' UNION ALL '.join(parts)}")


def _keys(folder: Folder) -> list[str]:
    return [k for k in PERIOD if getattr(folder, k) is not None]


def _period(folder: Folder) -> tuple:
    return folder.year, folder.month


def _own_columns(spark: SparkSession, table: str) -> tuple[StructType, list[str]]:
    """Columns without the partition columns, and those."""
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return StructType([f for f in spark.table(table).schema if f.name not in keys]), keys


def _drop_partition(spark: SparkSession, table: str, spelled: str) -> None:
    """Take a directory out of a table; the files stay."""
    parts = [p.partition("=") for p in spelled.split("/")]
    spec = ", ".join(f"{k} = {int(v)}" for k, _, v in parts if v.lstrip("-").isdigit())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _widening(source: str, schema: StructType, whole: StructType, period: Mapping[str, str]) -> str:
    have = {f.name.lower() for f in schema}
    columns = [
        f"CAST({f'`{f.name}`' if f.name.lower() in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in whole
    ]
    columns += [f"CAST({value} AS int) AS {k}" for k, value in period.items()]
    return f"SELECT {', '.join(columns)} FROM {source}"


# --- landing --------------------------------------------------------------------


def land_periods(
    spark: SparkSession,
    landing: str,
    target: str,
    periods: Sequence[tuple[int, int]],
    skip_existing: bool = True,
    name_pattern: str = "*_{year}-{month:02d}.parquet",
    file_bytes: int = TARGET_FILE_BYTES,
) -> list[dict]:
    """Bring monthly files from a landing directory into ``target``.

    A file belongs to the month in its name, whatever its rows say.  All columns of all
    files of a month are kept; files of one month that give a column different types
    are refused.  A month is written to the directory it is already in, however that is
    spelled, as about one file for ``file_bytes``.  It is staged, its rows are held against
    the footers of its sources, and only then does it take the place of what was
    there, see ``commit``; a landing that fails leaves the old month.

    A month that is there, see ``is_complete``, is skipped, unless it was landed from files that are others
    now.  Returns one outcome per period: success, skipped, path, rows, error.
    """
    outcomes = []
    for year, month in periods:
        path = f"{target.rstrip('/')}/year={year}/month={month}"
        outcome = {
            "year": year, "month": month, "success": True, "skipped": False,
            "path": path, "rows": None, "error": None,
        }
        try:
            recover(spark, target, path)
            there = folders(spark, target, year, month)
            path = outcome["path"] = there[0].path if there else path
            files = data_files(spark, landing, name_pattern.format(year=year, month=month))
            whole = next((f.path for f in there if is_complete(spark, f.path)), None)
            if skip_existing and whole and not changed(spark, whole, files):
                outcome.update(skipped=True, path=whole)
            else:
                if not files:
                    raise FileNotFoundError(f"no files of {year}-{month:02d} in {landing}")
                outcome["rows"] = _land(spark, target, path, files, [f.path for f in there[1:]], file_bytes)
        except Exception as failure:  # one month's failure leaves the others
            outcome.update(success=False, error=cause_of(failure))
        outcomes.append(outcome)
    return outcomes


def _land(
    spark: SparkSession, root: str, path: str, files: Sequence[Entry], others: Sequence[str], file_bytes: int
) -> int:
    """One month's files into its directory; returns the rows."""
    raw = read_raw(spark, [e.path for e in files])
    rows = footer_rows(spark, [e.path for e in files])
    count = max(1, math.ceil(sum(e.length for e in files) / file_bytes))
    return replace_folder(
        spark,
        root,
        path,
        lambda staged: raw.coalesce(count).write.parquet(staged),
        described(files, rows),
        sum(rows.values()),
        others,
    )


def read_raw(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files of one month with all their columns, each read by its own schema."""
    groups = _file_schemas(spark, paths)
    try:
        whole = merged([schema for schema, _ in groups])
    except SchemaConflict as conflict:
        named = "; ".join(f"{', '.join(files)}: {schema.simpleString()}" for schema, files in groups)
        raise SchemaConflict(f"{conflict} ({named})") from None
    out = None
    for schema, files in groups:
        part = as_schema(spark.read.schema(schema).parquet(*files), whole)
        out = part if out is None else out.unionByName(part)
    return out


def cause_of(failure: Exception) -> str:
    """The first line of what went wrong at the root."""
    java = getattr(failure, "java_exception", None) or getattr(failure, "_origin", None)
    while java is not None and java.getCause() is not None:
        java = java.getCause()
    text = java.toString() if java is not None else f"{type(failure).__name__}: {failure}"
    return next((line for line in text.splitlines() if line.strip()), type(failure).__name__)
