"""CSV tables to Parquet, counted on the way, damaged rows set aside."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .counted import TableCounts, counted
from .files import read_csv, table_path, write_table
from .quarantine import ingest_marked, read_marked
from .schemas import SCHEMAS, YEAR_PARTITION
from .scratch import move_folder, remove_folder


def ingest(
    spark: SparkSession,
    csv_paths: Mapping[str, str],
    folder: str,
    *,
    compression: str = "zstd",
    multi_line: Sequence[str] = (),
    orders_by_year: bool = False,
    quarantine: str | None = None,
    most_damaged: float = 0.01,
    **options,
) -> dict[str, TableCounts]:
    """Convert CSV tables to Parquet, one ``<table>.parquet`` folder each, and return the counts of each, taken as it is
    written.

    ``csv_paths`` maps table names of ``SCHEMAS`` to files. ``multi_line`` names tables whose quoted
    text holds line breaks. ``orders_by_year`` partitions orders by year of purchase. Other options
    go to the CSV reader.

    A damaged row fails the job. With ``quarantine``, a folder, such rows go to ``<table>.parquet`` there (``file,
    record, reason``) and the others are ingested; a share of more than ``most_damaged`` fails the job and leaves the
    table as it was.
    """
    unknown = sorted(set(csv_paths) - set(SCHEMAS))
    if unknown:
        raise ValueError(f"unknown tables {unknown}; known are {sorted(SCHEMAS)}")
    counts = {}
    for table, path in csv_paths.items():
        by_year = table == "orders" and orders_by_year

        def write(df: DataFrame, path: str = table_path(folder, table), by_year: bool = by_year) -> None:
            if by_year:
                df = df.withColumn(YEAR_PARTITION, F.year("order_purchase_timestamp"))
                # A file or a few per year, however many tasks read the text.
                df = df.hint("rebalance", YEAR_PARTITION)
            write_table(df, path, compression=compression, partition_by=(YEAR_PARTITION,) if by_year else ())

        lines = {"multi_line": table in multi_line, **options}
        if quarantine is None:
            counts[table] = counted(read_csv(spark, path, SCHEMAS[table], **lines), write)
            continue
        schema, staging = StructType.fromDDL(SCHEMAS[table]), f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"
        aside = table_path(quarantine, table)
        remove_folder(spark, aside)
        try:
            counts[table], _ = ingest_marked(
                read_marked(spark, path, schema, **lines), schema, lambda df: write(df, staging),
                lambda df: write_table(df, aside, compression=compression), most_damaged, **options,
            )
            move_folder(spark, staging, table_path(folder, table))
        finally:
            remove_folder(spark, staging)
    return counts
