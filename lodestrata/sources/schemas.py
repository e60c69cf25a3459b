"""Schemas of files that belong together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]
_REAL = [FloatType(), DoubleType()]


class SchemaConflict(ValueError):
    """Files give one column types that do not agree."""


def widened(a: DataType, b: DataType) -> DataType:
    """A type that holds the values of both; text if nothing narrower does."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    numbers = (*_WHOLE, *_REAL)
    if (a in numbers or isinstance(a, DecimalType)) and (b in numbers or isinstance(b, DecimalType)):
        return DoubleType()
    if isinstance(a, DateType) and isinstance(b, TimestampType | TimestampNTZType):
        return b
    if isinstance(b, DateType) and isinstance(a, TimestampType | TimestampNTZType):
        return a
    return StringType()


def merged(schemas: Sequence[StructType], widen: bool = False) -> StructType:
    """All columns in order of appearance, by name without regard to case and in the
    first spelling.  Types that differ are widened, or raise ``SchemaConflict``."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema:
            known = fields.get(f.name.lower())
            if known is None:
                fields[f.name.lower()] = StructField(f.name, f.dataType)
            elif known.dataType != f.dataType:
                if not widen:
                    raise SchemaConflict(
                        f"column {f.name} is {known.dataType.simpleString()} and {f.dataType.simpleString()}"
                    )
                fields[f.name.lower()] = StructField(known.name, widened(known.dataType, f.dataType))
    return StructType(list(fields.values()))


def drifts(schema: StructType, whole: StructType) -> bool:
    """Whether a column has another type in ``whole``."""
    types = {f.name.lower(): f.dataType for f in whole}
    return any(types[f.name.lower()] != f.dataType for f in schema)


def as_schema(df: DataFrame, whole: StructType) -> DataFrame:
    """Columns, spellings and types of ``whole``; columns ``df`` lacks are null."""
    have = {name.lower() for name in df.columns}
    return df.select(
        *(
            (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in whole
        )
    )
