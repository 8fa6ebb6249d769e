"""Scratch folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .files import read_parquet, write_table


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share: in ``spark.checkpoint.dir``, or in the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder and all in it, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, which is removed."""
    remove_folder(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write an intermediate table and read it back: lost executors cost no recomputation before it."""
    path = f"{folder}/{name}"
    write_table(df, path)
    return read_parquet(df.sparkSession, path, df.schema)
