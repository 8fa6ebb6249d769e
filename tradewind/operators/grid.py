"""Counts per map cell at every zoom level, in place of drawing points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Bounds = tuple[float, float]


def _cell(value: Column, bounds: Bounds, level: int) -> Column:
    """The cell of a value, from 0; values outside the bounds belong to the cells at the border."""
    low, high = bounds
    cells = 1 << level
    at = F.floor((value - low) / ((high - low) / cells)).cast("long")
    return F.least(F.greatest(at, F.lit(0)), F.lit(cells - 1))


def grid_pyramid(
    df: DataFrame, y: str, x: str, finest: int = 8, *, y_bounds: Bounds = (-90.0, 90.0), x_bounds: Bounds = (-180.0, 180.0)
) -> DataFrame:
    """``level, y, x, points``: the points in each cell that has any, from one cell at level 0 to 2 to the power ``finest``
    by as many at the finest level. Points without a position, or not a number, are left out.

    Points are read once and grouped by their finest cell; a cell of level n is made of four of level n + 1, so all
    other levels come from those few rows, not from the points. A place with very many points is one row per task.
    """
    known = df.select(F.col(y).cast("double").alias("_y"), F.col(x).cast("double").alias("_x"))
    known = known.filter(F.col("_y").isNotNull() & F.col("_x").isNotNull() & ~F.isnan("_y") & ~F.isnan("_x"))
    cells = known.groupBy(_cell(F.col("_y"), y_bounds, finest).alias("_y"), _cell(F.col("_x"), x_bounds, finest).alias("_x"))
    base = cells.agg(F.count(F.lit(1)).alias("_points"))
    level = F.explode(F.sequence(F.lit(0), F.lit(finest))).alias("level")
    every = base.select("*", level)
    coarser = [F.call_function("shiftright", F.col(c), F.lit(finest) - F.col("level")).alias(c[1:]) for c in ("_y", "_x")]
    return every.groupBy("level", *coarser).agg(F.sum("_points").alias("points"))
