"""CSV rows that cannot be read as their types, set aside with file and reason."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .counted import TableCounts, counted
from .files import read_csv

RECORD = "_damaged_record"
FILE = "_file"


class TooDamaged(ValueError):
    """More rows are damaged than allowed."""


def read_marked(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """The rows of CSV files with ``RECORD``, the text of rows that could not be read, and ``FILE``, where they are."""
    own = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    marked = StructType([*own.fields, StructField(RECORD, StringType())])
    # Without all columns the reader would not notice rows with too few or too many values.
    rows = read_csv(spark, path, marked, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, columnPruning=False, **options)
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def _reason(schema: StructType, options: dict) -> Column:
    """The columns whose text is no value of their type, or that the row has too few or too many values."""
    parser = {k: str(v) for k, v in options.items() if k in ("escape", "quote", "sep")}
    raw = F.from_csv(F.col(RECORD), ", ".join(f"`{f.name}` string" for f in schema), parser)
    wrong = [
        F.when(raw[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), raw[f.name]))
        for f in schema
        if not isinstance(f.dataType, StringType)
    ]
    found = F.concat_ws("; ", *wrong) if wrong else F.lit("")
    return F.when(found == "", F.lit(f"not {len(schema)} values")).otherwise(found)


def ingest_marked(
    marked: DataFrame, schema: StructType, write: Callable[[DataFrame], object], write_damaged: Callable[[DataFrame], object],
    most_damaged: float, **options,
) -> tuple[TableCounts, int]:
    """Write the good rows and count all in one pass; if there are damaged ones, write them too, from a second. Returns
    the good rows' counts and the number of damaged rows; fails where their share is above ``most_damaged``."""
    bad = F.col(RECORD).isNotNull()
    names = [f"`{f.name}`" for f in schema]
    # The observation stands before the filter, so it sees both kinds.
    seen = Observation()
    watched = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("damaged"))
    counts = counted(watched.filter(~bad).select(*names), write)
    rows, damaged = seen.get["rows"], seen.get["damaged"]
    if damaged > most_damaged * rows:
        raise TooDamaged(f"{damaged} of {rows} rows are damaged")
    if damaged:
        write_damaged(marked.filter(bad).select(F.col(FILE).alias("file"), F.col(RECORD).alias("record"), _reason(schema, options).alias("reason")))
    return counts, damaged

