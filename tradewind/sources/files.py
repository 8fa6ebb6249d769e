"""CSV and Parquet files in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import TEXT_FORMAT
from .schemas import SCHEMAS


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    multi_line: bool = False,
    mode: str = "FAILFAST",
    **options,
) -> DataFrame:
    """A comma-separated file (or folder of files) with a header.

    With a schema there is no inference pass, and the header must list the schema's columns, so a
    reordered file fails instead of shifting its values. Without one the types are inferred.
    ``multi_line`` allows line breaks inside quotes; such files cannot be split over tasks. A value
    that cannot be read as its type fails the job; ``mode="PERMISSIVE"`` makes it null instead.
    """
    reader = spark.read.options(header=True, sep=",", timestampFormat=TEXT_FORMAT, multiLine=multi_line, mode=mode, **options)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    return reader.schema(schema).csv(path, enforceSchema=False)


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, *, compression: str = "zstd", partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table."""
    df.write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)


def columns_at(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Columns by position; negative positions count from the end."""
    return df.select(*(df.columns[i] for i in positions))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows of an order, as a result rather than a printout."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def table_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}.parquet"


def open_tables(spark: SparkSession, folder: str, tables: Sequence[str] = tuple(SCHEMAS)) -> dict[str, DataFrame]:
    """The ingested Parquet tables by name."""
    return {table: read_parquet(spark, table_path(folder, table)) for table in tables}


def open_csv_tables(
    spark: SparkSession, csv_paths: Mapping[str, str], *, multi_line: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """The CSV tables by name, for reports straight from CSV. ``multi_line`` is as in ``ingest``."""
    return {
        table: read_csv(spark, path, SCHEMAS[table], multi_line=table in multi_line) for table, path in csv_paths.items()
    }
