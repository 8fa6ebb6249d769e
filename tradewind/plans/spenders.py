"""Top-spending customers.

Payments are reduced to one row per order first; the join with orders needs that partitioning
anyway, and an order with very many payments cannot skew it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_date, cents, in_year, merge_cents, month_label, to_amount, year_before_last
from ..operators import join_spread, top_rows
from ..sources.schemas import YEAR_PARTITION

PURCHASE = "order_purchase_timestamp"


def max_payment_by_month(
    orders: DataFrame, payments: DataFrame, year: int | None = None, *, keys: Sequence[str] = ("order_id",)
) -> DataFrame:
    """``customer_id, month, year, max_cash``: the largest single payment of every month.

    ``keys`` are the columns that orders and payments are joined on; bucketed tables have two.

    The largest payment of a month is the largest per customer of that month too, so nothing needs
    to be grouped by customer. Equal payments: the smaller ``customer_id``.
    """
    largest = payments.groupBy(*keys).agg(F.max(cents("payment_value")).alias("paid"))
    if year is not None:
        orders = orders.filter(in_year(orders, PURCHASE, year, partition=YEAR_PARTITION))
    day = as_date(orders, PURCHASE)
    placed = orders.select(*keys, "customer_id", F.month(day).alias("month"), F.year(day).alias("year"))
    best = top_rows(placed.join(largest, list(keys)), ["year", "month"], "paid", 1, tie_break=["customer_id"])
    return best.select("customer_id", "month", "year", to_amount("paid").alias("max_cash"))


def month_payments(
    orders: DataFrame, payments: DataFrame, *, year: int | None = None, excluded_status: str = "canceled",
    keys: Sequence[str] = ("order_id",),
) -> DataFrame:
    """``order_purchase_month, customer_id, paid``: sum in cents per customer and month of one year.

    Orders with the excluded status or none at all are left out. The default year is the last full
    one. ``keys`` are the columns that orders and payments are joined on.
    """
    wanted = year_before_last(orders, PURCHASE) if year is None else year
    bought = in_year(orders, PURCHASE, wanted, partition=YEAR_PARTITION)
    placed = orders.filter((F.col("order_status") != excluded_status) & bought).select(
        *keys, "customer_id", F.month(as_date(orders, PURCHASE)).alias("order_purchase_month")
    )
    per_order = payments.groupBy(*keys).agg(F.sum(cents("payment_value")).alias("paid"))
    return (
        placed.join(per_order, list(keys)).groupBy("order_purchase_month", "customer_id").agg(F.sum("paid").alias("paid"))
    )


def month_spending(paid: DataFrame) -> DataFrame:
    """``order_purchase_month, customer_id, month_payment``: the customer who paid most, per month.

    Takes the result of ``month_payments``. Equal sums: the smaller ``customer_id``.
    """
    best = top_rows(paid, ["order_purchase_month"], "paid", 1, tie_break=["customer_id"])
    return best.select("order_purchase_month", "customer_id", to_amount("paid").alias("month_payment")).orderBy(
        "order_purchase_month"
    )


def month_spending_unique(paid: DataFrame, customers: DataFrame) -> DataFrame:
    """``order_purchase_month, customer_unique_id, month_payment, customer_id``: the same per person.

    One row per id of the person who paid most in a month, so a person with very many ids is a long
    result, not a long row. There is one winner a month, whose row is joined with that person's ids
    in parts.
    """
    people = customers.select("customer_id", "customer_unique_id")
    per_person = (
        paid.join(people, "customer_id")
        .groupBy("order_purchase_month", "customer_unique_id")
        .agg(merge_cents("paid").alias("paid"))
    )
    best = top_rows(per_person, ["order_purchase_month"], "paid", 1, tie_break=["customer_unique_id"])
    months = best.groupBy("customer_unique_id").agg(F.collect_list(F.struct("order_purchase_month", "paid")).alias("months"))
    won = join_spread(people, months.filter(F.col("customer_unique_id").isNotNull()), ["customer_unique_id"])
    return (
        won.select("customer_unique_id", F.col("customer_id").cast("string").alias("customer_id"), F.inline("months"))
        .select("order_purchase_month", "customer_unique_id", to_amount("paid").alias("month_payment"), "customer_id")
        .orderBy("order_purchase_month", "customer_unique_id", "customer_id")
    )


def latest_purchase(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row: date of the newest paid order."""
    paid = payments.select("order_id").distinct()
    bought = orders.select("order_id", as_date(orders, PURCHASE).alias("day")).join(paid, "order_id", "left_semi")
    return bought.agg(F.max("day").alias("latest_purchase"))


def winner_count(winners: DataFrame, column: str = "customer_id") -> DataFrame:
    """One row: number of different winners."""
    return winners.agg(F.count_distinct(column).alias("no_customers"))


def with_month_label(df: DataFrame, month: str = "order_purchase_month") -> DataFrame:
    return df.withColumn("month_label", month_label(F.col(month)))


def status_list(orders: DataFrame) -> DataFrame:
    return orders.select("order_status").distinct()
