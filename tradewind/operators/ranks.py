"""Positions and complete ranks without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .joins import join_spread

# ``monotonically_increasing_id`` holds the task above this many bits and the row's number in the task below.
ROW_BITS = 33
# A value with more than one in this many rows counts as very common, and the parts its rows are dealt to.
HOT_VALUES = 1000
HOT_PARTS = 64


def _ordered(df: DataFrame, order: Sequence[str | Column], folder: str) -> tuple[DataFrame, Column, Column]:
    """The rows in an order over all tasks, written once; the number of each row's task, and its number there."""
    at = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    kept = materialize(at, folder, "ordered")
    return kept, F.shiftright("_at", ROW_BITS).cast("int"), F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)


def _starts(sums: dict[int, int]) -> Column:
    """Per task what the tasks before it hold together, as an array. One number per task reaches the driver."""
    each = [sums.get(i, 0) for i in range(max(sums, default=0) + 1)]
    return F.array(*(F.lit(x).cast("long") for x in accumulate(each[:-1], initial=0)))


def positions(df: DataFrame, order: Sequence[str | Column], folder: str, name: str = "position") -> DataFrame:
    """Adds each row's place in an order over all rows, from 0.

    Rows are dealt to tasks by ranges of the order, sorted there and written below ``folder``; a place is the number of
    rows in the tasks before plus the number in the own task. Rows that agree in the whole order go to one task, so a
    column that tells them apart belongs at its end where many may agree.
    """
    kept, task, row = _ordered(df, order, folder)
    sizes = {r["task"]: r["n"] for r in kept.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return kept.withColumn(name, F.get(_starts(sizes), task) + row).drop("_at")


def complete_rank(df: DataFrame, measure: str, folder: str, groups: Sequence[str] = ()) -> DataFrame:
    """Adds ``rank``, ``dense_rank`` and ``percent_rank`` by descending measure, null last, to every row, per group.

    Equal values are one row with their number before anything is ordered. The different values get their places by
    ranges, one task per range, and the rows before a value are summed there, so ties across a border share a rank.
    Rows find their value by a join, where those of a very common value are dealt to parts. Writes below ``folder``.
    """
    keys = [*groups, measure]
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    order = [*(F.col(g).asc_nulls_first() for g in groups), F.col(measure).desc_nulls_last()]
    kept, task, row = _ordered(values, order, folder)
    sums = kept.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("values"), F.sum("_n").alias("rows")).collect()
    inside = Window.partitionBy("_task").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    first, before = (_starts({r["task"]: r[c] for r in sums}) for c in ("values", "rows"))
    placed = kept.withColumn("_task", task).withColumns({
        "_place": F.get(first, F.col("_task")) + row,
        "_before": F.get(before, F.col("_task")) + F.coalesce(F.sum("_n").over(inside), F.lit(0)),
    })
    if groups:
        bases = placed.groupBy(*groups).agg(
            F.min("_place").alias("_first"), F.min("_before").alias("_base"), F.sum("_n").alias("_rows")
        )
        placed = join_spread(placed, bases, groups)
    else:
        every = F.lit(sum(r["rows"] for r in sums)).cast("long")
        placed = placed.withColumns({"_first": F.lit(0), "_base": F.lit(0), "_rows": every})
    rank = F.col("_before") - F.col("_base") + 1
    percent = F.when(F.col("_rows") > 1, (rank - 1) / (F.col("_rows") - 1)).otherwise(F.lit(0.0))
    ranks = {"rank": rank, "dense_rank": F.col("_place") - F.col("_first") + 1, "percent_rank": percent}
    ranked = placed.select(*keys, "_n", *(x.alias(f"_{name}") for name, x in ranks.items()))

    # Fewer than HOT_VALUES values have more than that share of the rows.
    total = max(sum(r["rows"] for r in sums), 1)
    parts = F.when(F.col("_n") * HOT_VALUES > total, F.lit(HOT_PARTS)).otherwise(1)
    hot = F.broadcast(ranked.filter(F.col("_n") * HOT_VALUES > total).select(*(F.col(k).alias(f"_hot_{k}") for k in keys), F.lit(HOT_PARTS).alias("_parts")))
    same = reduce(lambda a, b: a & b, (df[k].eqNullSafe(hot[f"_hot_{k}"]) for k in keys))
    dealt = df.join(hot, same, "left").select(*(df[c] for c in df.columns), F.pmod(F.xxhash64(*df.columns), F.coalesce("_parts", F.lit(1))).cast("int").alias("_part"))
    found = ranked.select(
        *(F.col(k).alias(f"_own_{k}") for k in keys), *(f"_{name}" for name in ranks), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_own_part")
    )
    same = reduce(lambda a, b: a & b, (dealt[k].eqNullSafe(found[f"_own_{k}"]) for k in keys), dealt["_part"] == found["_own_part"])
    return dealt.join(found, same).select(*df.columns, *(F.col(f"_{name}").alias(name) for name in ranks))
