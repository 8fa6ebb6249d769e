"""Grouped aggregates. All of them combine on the map side, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "count", weight: str | None = None) -> DataFrame:
    """Rows per key. ``weight`` names the count column of an input that is already grouped."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(rows.alias(name))


def sum_by(
    df: DataFrame, dimension: str, measure: str, *, dimensions: Collection[str], measures: Collection[str]
) -> DataFrame:
    """Sum of a chosen measure by a chosen dimension, each out of a list of allowed columns."""
    if dimension not in dimensions:
        raise ValueError(f"unknown dimension {dimension!r}; choose one of {sorted(dimensions)}")
    if measure not in measures:
        raise ValueError(f"unknown measure {measure!r}; choose one of {sorted(measures)}")
    return df.groupBy(dimension).agg(F.sum(measure).alias(measure))


def mean_by_key(df: DataFrame, key: str, **columns: str) -> DataFrame:
    """One row per key with the means of some columns (``new_name="column"``).

    Collapses a lookup that has many rows per key, so that joining it cannot multiply rows.
    """
    return df.groupBy(key).agg(*(F.avg(source).alias(name) for name, source in columns.items()))
