"""Counts of a table taken while it is written: no second read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType, VariantType

# Types without an order, of which only nulls are counted.
UNORDERED = (ArrayType, BinaryType, MapType, StructType, VariantType)


@dataclass(frozen=True)
class ColumnCounts:
    """``least`` and ``largest`` are None for a column of nulls or without an order."""

    nulls: int
    least: Any
    largest: Any


@dataclass(frozen=True)
class TableCounts:
    rows: int
    columns: dict[str, ColumnCounts]


def counted(df: DataFrame, write: Callable[[DataFrame], object]) -> TableCounts:
    """Write a frame by ``write``, which runs one job over it, and return its rows and, per column, nulls, least and
    largest value, taken as the rows go by."""
    seen = Observation()
    ordered = [not isinstance(f.dataType, UNORDERED) for f in df.schema]
    values = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(df.columns):
        column = df[f"`{name}`"]
        values.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        if ordered[i]:
            values += [F.min(column).alias(f"least_{i}"), F.max(column).alias(f"largest_{i}")]
    write(df.observe(seen, *values))
    found = seen.get
    columns = {
        name: ColumnCounts(found[f"nulls_{i}"], found.get(f"least_{i}"), found.get(f"largest_{i}")) for i, name in enumerate(df.columns)
    }
    return TableCounts(found["rows"], columns)


def counts_table(spark: SparkSession, counts: Mapping[str, TableCounts], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``table, column, rows, nulls, least, largest``, the last two as text; of some columns, or of all."""
    lines = [
        (table, name, found.rows, c.nulls, None if c.least is None else str(c.least), None if c.largest is None else str(c.largest))
        for table, found in counts.items()
        for name, c in found.columns.items()
        if columns is None or name in columns.get(table, ())
    ]
    return spark.createDataFrame(lines, "table string, column string, rows long, nulls long, least string, largest string")
