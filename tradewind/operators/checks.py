"""Data checks: profile, nulls, duplicates, lookups, samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls of each column, in one pass."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns))


def profile(df: DataFrame, distinct: Sequence[str] = ()) -> DataFrame:
    """One row per column: name, type, rows, nulls, and the exact number of distinct values for the named columns.

    A distinct count groups by the column's own values: equal values meet before the shuffle, nulls
    and rows fall out of the same groups, and each branch reads its one column only.
    """
    types = {field.name: field.dataType.simpleString() for field in df.schema}
    counted = [
        df.groupBy(F.col(name).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.lit(name).alias("column"),
            F.lit(types[name]).alias("type"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
        )
        for name in distinct
    ]
    others = [name for name in df.columns if name not in distinct]
    if others:
        totals = df.agg(
            F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(others))
        )
        lines = F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit(types[c]).alias("type"),
                        F.col("rows"),
                        F.col(f"n{i}").alias("nulls"),
                        F.lit(None).cast("long").alias("distinct_values"),
                    )
                    for i, c in enumerate(others)
                )
            )
        )
        counted.append(totals.select(lines))
    return reduce(DataFrame.unionByName, counted)


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their ``count``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail if a key repeats. Runs a job, so it belongs in batch jobs, not inside a lazy plan."""
    if not duplicate_groups(df, [key]).isEmpty():
        raise ValueError(f"{key} is not unique; joining it would count rows twice")
    return df


def look_up(df: DataFrame, column: str, value) -> DataFrame:
    """All rows with one value, compared in the column's own type so that the scan can use it."""
    return df.filter(F.col(column) == F.lit(value).cast(df.schema[column].dataType))


def distinct_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: all rows, distinct combinations, and their ratio, from one grouping."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    counts = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows"))
    return counts.withColumn("ratio", F.try_divide(F.col("distinct_rows").cast("double"), F.col("rows").cast("double")))


def sample_points(df: DataFrame, columns: Sequence[str], fraction: float, *, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Bernoulli sample of some columns, decided row by row in the scan stage by a hash of the row's key.

    The same rows come at any file layout. ``key`` names integer or text columns; rows that agree in
    all of them are taken or left together.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key))
    drawn = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.filter(drawn < int(fraction * 2**32)).select(*columns)


def fixed_sample(
    df: DataFrame, n: int, *, key: Sequence[str], seed: int = 0, weight: str | None = None, priority: str = "priority"
) -> DataFrame:
    """``n`` rows, or all if there are fewer, with a ``priority``, smallest first; the same at any file layout.

    The priority is a hash of the row's key, as a number between 0 and 1. With a ``weight`` it is the waiting time of that
    number at the rate of the weight, so that rows are drawn in proportion to it; rows without a positive weight are never
    drawn. Every task keeps its ``n`` first rows. Rows that agree in the whole key tie. A sample is at most ``n`` rows in one
    task, so ``n`` is meant for a map or a report.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key))
    drawn = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 1) / float(2**52 + 1)
    if weight is not None:
        drawn = F.when(F.col(weight) > 0, -F.log(drawn) / F.col(weight))
    rows = df.withColumn(priority, drawn).filter(F.col(priority).isNotNull())
    return rows.orderBy(priority, *key).limit(n)


def merge_samples(samples: Sequence[DataFrame], n: int, *, key: Sequence[str], priority: str = "priority") -> DataFrame:
    """The sample of all rows from the samples of parts of them, each of ``n`` rows or more by the same rule."""
    return reduce(DataFrame.unionByName, samples).orderBy(priority, *key).limit(n)
