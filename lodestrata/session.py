"""Session settings the library is written for."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Trip and weather times carry no zone; a zone with daylight saving time
    # would change durations and dates.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # A partitioned write sorts its rows by partition unless it may keep a few
    # files open; a year has twelve.
    "spark.sql.maxConcurrentOutputFileWriters": "12",
}

SHUFFLE_BYTES_PER_TASK = 128 * 1024 * 1024
ROW_BYTES_PER_FILE_BYTE = 4  # shuffled rows against compressed Parquet


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_sized_for(spark: SparkSession, file_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions for an input of ``file_bytes``, so that each fits
    a task's memory.  Adaptive execution merges those that turn out small."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    needed = math.ceil(file_bytes * ROW_BYTES_PER_FILE_BYTE / SHUFFLE_BYTES_PER_TASK)
    spark.conf.set(key, str(max(int(before), needed)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
