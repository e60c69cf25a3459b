"""Shared small helpers: tables, the shared folder, Arrow batches, fold columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StringType, StructType

#: Text handled at a time inside a task.
SLICE_BYTES = 1 << 20
#: Tables that ``stored`` wrote and nobody has removed.
_MADE: list[str] = []


class Kept:
    """A bounded table in two generations: what is looked up again outlives what is not."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def older(self, key):
        """The value that ``young`` lacks, from the generation before."""
        found = self.old.get(key)
        if found is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Where the session names none, a new one is
    made if the session runs in one process, as in tests; a cluster must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            folder = known.get()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="lodestrata-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: cuts the
    lineage, survives lost executors, and is computed once."""
    path = scratch(df.sparkSession, name)
    _MADE.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made() -> list[str]:
    """The tables that ``stored`` has written so far."""
    return list(_MADE)


def release(spark: SparkSession, before: Sequence[str] = (), keep: Sequence[DataFrame] = ()) -> None:
    """Remove the tables that ``stored`` wrote, but those made ``before`` and those that the frames of
    ``keep`` are.  For when the results that read them have been written."""
    kept = {f.rstrip("/").rpartition("/")[0] for df in keep for f in df.inputFiles()}
    for path in made():
        if path not in before and not any(k.endswith(path.split("://")[-1]) for k in kept):
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
            _MADE.remove(path)


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, by ``modulus``; null ids belong to remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(0))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [start, stop) of a text column with about ``limit`` bytes each."""
    if len(texts) == 0:
        return
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
    start = 0
    while start < len(texts):
        floor = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, floor + limit, "right")))
        yield start, stop
        start = stop


def map_texts(
    df: DataFrame,
    text: str,
    schema: list[tuple[str, pa.DataType]],
    make: Callable[[], Callable[[list[str | None]], list]],
    keep: Sequence[str] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """The columns ``keep`` (default: all) and new ones, in one Python pass.

    ``make`` runs once in a task and returns the function for a slice of texts (null
    as None), which returns a list of values, or an Arrow array, for each new column.
    Its attribute ``close``, if it has one, is called when the task's rows are done.
    Rows are neither dropped nor reordered.  A new column takes the place of a kept one of its name.
    """
    made_names = {name.lower() for name, _ in schema}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made_names]
    columns = [F.col(f"`{c}`") for c in keep]
    at = keep.index(text) if text in keep and df.schema[text].dataType == StringType() else None
    if at is None:
        at = len(columns)
        columns.append(F.col(f"`{text}`").cast("string").alias("__text"))
    source = df.select(*columns)
    out = StructType(source.schema[: len(keep)].fields + from_arrow_schema(pa.schema(schema)).fields)
    kinds = [kind for _, kind in schema]
    names = keep + [name for name, _ in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start, stop in slices(batch.column(at), limit):
                part = batch.slice(start, stop - start)
                made = work(part.column(at).to_pylist())
                made = [
                    v if isinstance(v, pa.Array) else pa.array(v, kind)
                    for v, kind in zip(made, kinds, strict=True)
                ]
                own = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(own + made, names=names)
        # Python workers live on for other tasks: leave nothing in them.
        getattr(work, "close", lambda: None)()
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, out)


def list_array(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.Array:
    """List column from flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))
