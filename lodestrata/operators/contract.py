"""Schema contracts: names, types and defaults of a table, applied in one select."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnRule:
    """One target column.

    ``sources`` are the names it may have in the input besides ``target``.  A
    required column must be there; an optional one gets ``default`` if absent.
    """

    target: str
    type: str
    sources: tuple[str, ...] = ()
    required: bool = True
    default: Any = None


@dataclass(frozen=True)
class TableContract:
    columns: tuple[ColumnRule, ...]


def _by_lower_name(df: DataFrame) -> dict[str, str]:
    return {name.lower(): name for name in df.columns}


def rename_existing(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; names compare as Spark compares them."""
    present = _by_lower_name(df)
    return df.withColumnsRenamed(
        {present[old.lower()]: new for old, new in mapping.items() if old.lower() in present}
    )


def tag(df: DataFrame, name: str, value: Any) -> DataFrame:
    """Constant column."""
    return df.withColumn(name, F.lit(value))


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Contract columns first, then all other input columns untouched.

    A value that cannot be cast becomes null, so that the validity rules decide
    about its row.  Names are matched without regard to case: a column that is
    there under another spelling keeps its values.
    """
    present = _by_lower_name(df)
    types = dict(df.dtypes)
    taken: set[str] = set()
    missing: list[str] = []
    out: list[Column] = []
    for rule in contract.columns:
        names: Sequence[str] = (*rule.sources, rule.target)
        found = next((present[n.lower()] for n in names if n.lower() in present), None)
        if found is not None:
            taken.add(found)
            # No cast for a column of the right type keeps filters on it pushable.
            cast = f"try_cast(`{found}` AS {rule.type})"
            value = f"`{found}`" if types[found] == rule.type else cast
            out.append(F.expr(f"{value} AS {rule.target}"))
        elif rule.required:
            missing.append("/".join(names))
        else:
            out.append(F.lit(rule.default).cast(rule.type).alias(rule.target))
    if missing:
        raise ValueError(f"input lacks required columns: {', '.join(missing)}")
    extra = [F.col(f"`{name}`") for name in df.columns if name not in taken]
    return df.select(*out, *extra)
