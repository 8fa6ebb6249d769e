"""Helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word, in Python's and in Java's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
# Texts that a task holds as Python objects at a time.
SLICE_BYTES = 2_000_000
# Texts that a task encodes at a time, as Arrow arrays.
ENCODE_BYTES = 4_000_000
# `monotonically_increasing_id` holds the task above this many bits.
TASK_BITS = 33


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers that see the driver's folders import this library from there; a cluster gets it by
    `--py-files`."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share: in `spark.checkpoint.dir`, or in the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and reread it: what follows doesn't run the steps before it again, also
    when executors are lost."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gives_back(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task function, and at its end free memory goes back to the system: workers stay for later tasks and stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def set_aside(docs: DataFrame, own: tuple[str, ...]) -> DataFrame:
    """`docs` with all columns but the `own` ones renamed, in place, to names that no operator uses; `toDF` with the old
    names undoes it."""
    return docs.toDF(*(c if c in own else f"extra_{i}" for i, c in enumerate(docs.columns)))


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def running_totals(
    df: DataFrame, group: list[str], order: list[str], totals: dict[str, Column], buckets: int = 1024
) -> DataFrame:
    """Add for each name in `totals` the sum of its expression over the rows before this one in its group.

    Rows of a group stand in a fixed pseudorandom order: by a hash of the `order` columns, then by these. A group is
    cut by that hash, so a group with a third of all rows is summed by many tasks: sums per bucket, running sums
    over the at most `buckets` buckets of a group, and running sums inside each bucket. `group` columns must not be
    null. Rows that agree in all `order` columns may swap places. `df` is read twice.
    """
    keys = [*group, "_bucket"]
    parts = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sums = parts.groupBy(*keys).agg(*(F.sum(x).alias(f"_sum_{n}") for n, x in totals.items()))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*keys, *(F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_base_{n}") for n in totals))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = parts.select("*", *(F.coalesce(F.sum(x).over(inside), F.lit(0)).alias(f"_in_{n}") for n, x in totals.items()))
    return own.join(bases, keys).select(
        *df.columns, *((F.col(f"_base_{n}") + F.col(f"_in_{n}")).cast("long").alias(n) for n in totals)
    )


def ordered_totals(df: DataFrame, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """Add for each name in `totals` the sum of its expression over the rows before this one in an order over all rows.

    Rows are dealt to tasks by ranges of the order, sorted there and written; a sum is that of the tasks before and that of
    the own task's rows before. One number per task goes through the driver. Rows that agree in the whole order go to
    one task.
    """
    own = df.withColumns({f"_own_{n}": x for n, x in totals.items()}).repartitionByRange(*order).sortWithinPartitions(*order)
    kept = written(own.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumn("_task", F.shiftright("_at", TASK_BITS).cast("int"))
    sums = kept.groupBy("_task").agg(*(F.sum(f"_own_{n}").alias(n) for n in totals)).collect()
    found = {r["_task"]: r for r in sums}
    inside = Window.partitionBy("_task").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    added = []
    for name in totals:
        each = [found[i][name] if i in found else 0 for i in range(max(found, default=0) + 1)]
        starts = F.split(F.lit(",".join(map(str, accumulate(each[:-1], initial=0)))), ",").cast("array<double>" if any(isinstance(x, float) for x in each) else "array<long>")
        added.append((F.get(starts, F.col("_task")) + F.coalesce(F.sum(f"_own_{name}").over(inside), F.lit(0))).alias(name))
    return kept.select(*df.columns, *added)


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes of text, or of one row."""
    sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(sizes)
    start, done = 0, 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield start, stop
        done, start = int(ends[stop - 1]), stop


def text_batches(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of at most `most` bytes of their column `text`, or of one row."""
    for batch in batches:
        for start, stop in text_slices(batch.column("text"), most):
            yield batch.slice(start, stop - start)
