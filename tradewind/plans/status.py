"""Orders per status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..operators import count_by


def orders_per_status(orders: DataFrame, weight: str | None = None) -> DataFrame:
    """``order_status, amount``. ``weight`` names the count column of grouped input."""
    return count_by(orders, "order_status", name="amount", weight=weight)


def delivered_share(counts: DataFrame, delivered: str = "delivered") -> DataFrame:
    """One row: all orders, delivered orders, and their share from 0 to 1."""
    done = F.coalesce(F.sum(F.when(F.col("order_status") == delivered, F.col("amount"))), F.lit(0))
    totals = counts.agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("orders"), done.alias("delivered"))
    return totals.withColumn("delivered_share", ratio(F.col("delivered"), F.col("orders")))


def without_status(counts: DataFrame, status: str = "delivered") -> DataFrame:
    """The counts without one status; orders without any status stay."""
    return counts.filter(~F.col("order_status").eqNullSafe(status))
