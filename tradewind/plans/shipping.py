"""Orders handed to the carrier well before the promised date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_date
from ..operators import count_by

# Chart text for the two classes.
SHIPPED_EARLY = "Shipped more than 2 days before scheduled delivery date"
SHIPPED_LATE = "Shipped less than 2 days before scheduled delivery date"


def shipped_ahead(handed_over: Column, expected: Column, days: int = 2) -> Column:
    """True if more than ``days`` days were left; null if either date is."""
    return F.date_add(handed_over, days) < expected


def ship_ahead_flag(orders: DataFrame, days: int = 2) -> DataFrame:
    """Per order with both dates: the dates, ``two_days``, and ``critical``, its opposite."""
    dates = orders.select(
        "order_id",
        *(as_date(orders, c).alias(c) for c in ("order_delivered_carrier_date", "order_estimated_delivery_date")),
    ).dropna("any")
    ahead = shipped_ahead(F.col("order_delivered_carrier_date"), F.col("order_estimated_delivery_date"), days)
    return dates.withColumn("two_days", ahead).withColumn("critical", ~F.col("two_days"))


def ship_ahead_counts(flags: DataFrame, weight: str | None = None) -> DataFrame:
    """``two_days, count``. ``weight`` names the count column of grouped input."""
    return count_by(flags.filter(F.col("two_days").isNotNull()), "two_days", weight=weight)


def with_ship_label(counts: DataFrame) -> DataFrame:
    """Adds a ``label``, chosen by the flag's value."""
    return counts.withColumn("label", F.when(F.col("two_days"), SHIPPED_EARLY).otherwise(SHIPPED_LATE))
