"""Delivery delay.

An order is delayed if it was delivered on a later day than promised, undelivered if it has no
delivery date, and counted as delivered otherwise. All counts derive from one small table,
``delay_profile``: a single pass over the orders leaves one row per number of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_date, days_between, percent
from ..operators import count_by

# Class names of the result table and of its chart.
ORDER_TYPES = ("Delivered", "Delayed", "Undelivered")
CHART_ORDER_TYPES = ("Delivered on time", "Delivered with delay", "Undelivered")


def days_late(orders: DataFrame) -> Column:
    return days_between(
        as_date(orders, "order_estimated_delivery_date"), as_date(orders, "order_delivered_customer_date")
    )


def order_delay(orders: DataFrame) -> DataFrame:
    """``order_id, days_delayed`` of every delayed order."""
    return orders.select("order_id", days_late(orders).alias("days_delayed")).filter(F.col("days_delayed") > 0)


def delay_profile(orders: DataFrame) -> DataFrame:
    """``undelivered, days_late, no_orders``: orders per day difference; negative days are early."""
    undelivered = as_date(orders, "order_delivered_customer_date").isNull()
    days = orders.select(undelivered.alias("undelivered"), days_late(orders).alias("days_late"))
    return count_by(days, "undelivered", "days_late", name="no_orders")


def _delayed(profile: DataFrame) -> DataFrame:
    """A number of days implies a delivery date, so the profile has one row for each."""
    return profile.filter(F.col("days_late") > 0).select(F.col("days_late").alias("days_delayed"), "no_orders")


def delay_histogram(profile: DataFrame) -> DataFrame:
    """``days_delayed, no_orders`` of the delayed orders, by days."""
    return _delayed(profile).orderBy("days_delayed")


def delay_stats(profile: DataFrame) -> DataFrame:
    """One row ``count, mean, stddev, min, max`` of the delay in days.

    The sums run over whole numbers, so they are exact in any order of the partitions.
    """
    n, days = F.col("no_orders").cast("decimal(38,0)"), F.col("days_late")
    sums = profile.filter(days > 0).agg(
        F.coalesce(F.sum("no_orders"), F.lit(0)).alias("count"),
        F.sum(n * days).alias("total"),
        F.sum(n * days * days).alias("squares"),
        F.min(days).alias("min"),
        F.max(days).alias("max"),
    )
    rows = F.col("count").cast("double")
    total, squares = F.col("total").cast("double"), F.col("squares").cast("double")
    mean = F.try_divide(total, rows)
    spread = F.when(rows > 1, F.greatest(squares - total * mean, F.lit(0.0)) / (rows - 1))
    return sums.select("count", mean.alias("mean"), F.sqrt(spread).alias("stddev"), "min", "max")


def delay_summary(profile: DataFrame) -> DataFrame:
    """``delay_stats`` as five lines ``summary, days_delayed``, both text, as ``describe`` lays them out."""
    names = ("count", "mean", "stddev", "min", "max")
    lines = [F.struct(F.lit(c).alias("summary"), F.col(c).cast("string").alias("days_delayed")) for c in names]
    return delay_stats(profile).select(F.inline(F.array(*lines)))


def _totals(profile: DataFrame) -> DataFrame:
    n = F.col("no_orders")

    def orders_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return profile.agg(
        orders_where(F.lit(True)).alias("orders"),
        orders_where(F.col("days_late") > 0).alias("delayed"),
        orders_where(F.col("undelivered")).alias("undelivered"),
    )


def order_structure(profile: DataFrame, names: Sequence[str] = ORDER_TYPES) -> DataFrame:
    """``order_type, count``: neither delayed nor undelivered, delayed, undelivered."""
    counts = (F.col("orders") - F.col("delayed") - F.col("undelivered"), F.col("delayed"), F.col("undelivered"))
    lines = [F.struct(F.lit(name).alias("order_type"), n.alias("count")) for name, n in zip(names, counts)]
    return _totals(profile).select(F.inline(F.array(*lines)))


def delay_totals(profile: DataFrame) -> DataFrame:
    """One row with the numbers of delayed and undelivered orders and their percentages of all orders."""
    both = F.col("delayed") + F.col("undelivered")
    return _totals(profile).select(
        "orders",
        "delayed",
        percent(F.col("delayed"), F.col("orders")).alias("delayed_percent"),
        "undelivered",
        percent(F.col("undelivered"), F.col("orders")).alias("undelivered_percent"),
        both.alias("delayed_or_undelivered"),
        percent(both, F.col("orders")).alias("delayed_or_undelivered_percent"),
    )


def delay_percentage(
    profile: DataFrame, *, first_n: int | None = None, day_range: tuple[int, int] | None = None
) -> DataFrame:
    """The histogram with ``percentage`` of all delayed orders.

    ``first_n`` keeps the first n distinct delays, ``day_range`` those between two numbers of days.
    The total is a window over the histogram, which has one row per day at most; a separate sum
    would not share the pass over the orders once the range is pushed into it.
    """
    delayed = F.sum("no_orders").over(Window.partitionBy(F.lit(True)))
    histogram = _delayed(profile).withColumn("percentage", percent(F.col("no_orders"), delayed))
    if day_range is not None:
        histogram = histogram.filter(F.col("days_delayed").between(*day_range))
    histogram = histogram.orderBy("days_delayed")
    return histogram if first_n is None else histogram.limit(first_n)


def delayed_exactly(profile: DataFrame, days: int) -> DataFrame:
    """One row: number of orders delayed by exactly this many days."""
    return profile.filter((F.col("days_late") == days) & (F.col("days_late") > 0)).agg(
        F.coalesce(F.sum("no_orders"), F.lit(0)).alias("no_orders")
    )
