"""Top-n with fixed tie rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_spread


def top_rows(
    df: DataFrame, groups: Sequence[str], measure: str, n: int, *, tie_break: Sequence[str], position: str = "position"
) -> DataFrame:
    """At most ``n`` rows per group, largest measure first, equal measures in ``tie_break`` order.

    The filter sits directly on the window, so Spark keeps ``n`` rows per group in every task before
    the shuffle (``WindowGroupLimit``) and a hot group never arrives whole in one task. Spark does so
    up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 by default.
    """
    order = Window.partitionBy(*groups).orderBy(F.desc(measure), *tie_break)
    return df.withColumn(position, F.row_number().over(order)).filter(F.col(position) <= n)


def top_ranked(df: DataFrame, groups: Sequence[str], measure: str, n: int) -> DataFrame:
    """All rows whose ``rank()`` by descending measure is at most ``n``: ties are kept, however many.

    A row has rank <= n exactly when its measure reaches that of the n-th row of its group. That
    floor needs n rows per group only; the rows above it are then found by a plain filter or join,
    in parts, so a long tie or group stays spread over the tasks instead of passing through one
    window task. As in the window, null measures come last and count as equal.
    """
    if not groups:
        first = df.select(measure).orderBy(F.desc(measure)).limit(n)
        floor = first.agg(F.struct(F.min(measure).alias("least"), F.count_if(F.col(measure).isNull()).alias("nulls")))
        floor = floor.select(F.col(floor.columns[0]).alias("floor")).scalar()
        return df.filter((floor.getField("nulls") > 0) | (df[measure] >= floor.getField("least")))

    first = top_rows(df.select(*groups, measure), groups, measure, n, tie_break=[])
    floor = first.groupBy(*groups).agg(F.min(measure).alias("_least"), F.count_if(F.col(measure).isNull()).alias("_nulls"))
    reached = (F.col("_nulls") > 0) | (F.col(measure) >= F.col("_least"))
    return join_spread(df, floor, groups).filter(reached).select(*df.columns)


def best_wide(df: DataFrame, group: str, member: str, measure: str, *, k: int = 2, fill: str) -> DataFrame:
    """One row per group with columns ``1_best_seller`` ... ``k_best_seller``; missing places after the first get ``fill``.

    The columns are fixed by ``k``, not by the data, and need no extra pass to find pivot values.
    """
    ranked = top_rows(df.select(group, member, measure), [group], measure, k, tie_break=[member])
    places = [F.max(F.when(F.col("position") == i, F.col(member).cast("string"))) for i in range(1, k + 1)]
    places[1:] = [F.coalesce(place, F.lit(fill)) for place in places[1:]]
    return ranked.groupBy(group).agg(*(place.alias(f"{i}_best_seller") for i, place in enumerate(places, 1)))


def top_with_rest(df: DataFrame, key: str, measure: str, n: int, *, rest: str = "rest") -> DataFrame:
    """The ``n`` largest rows in descending order and one last row with the sum of all others.

    Expects one row per key. The remainder comes from sums inside the same query.
    """
    top = df.orderBy(F.desc(measure), key).limit(n).select(measure, key)
    in_top = top.agg(F.coalesce(F.sum(measure), F.lit(0))).scalar()
    others = df.agg((F.coalesce(F.sum(measure), F.lit(0)) - in_top).alias(measure)).select(measure, F.lit(rest).alias(key))
    both = top.withColumn("_rest", F.lit(False)).unionByName(others.withColumn("_rest", F.lit(True)))
    return both.orderBy("_rest", F.desc(measure), key).drop("_rest")
