"""Exact money sums.

Prices arrive as doubles with two decimals. Summing them as doubles depends on the order in which
partitions arrive; summing decimals is exact but several times slower, because each value is
boxed. Whole cents in a long are exact and stay in generated code. A per-key sum can hold
9.2e16 currency units before ANSI mode, Spark's default, raises an overflow error; sums over many
keys are therefore merged as 38-digit decimals, which is cheap on the few pre-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Whole cents up to here are told apart from fractions of a cent.
MOST_CENTS = 1e14


def cents(price: Column | str) -> Column:
    """Whole cents of a price. One with fractions of a cent, not a number, or out of range fails the job."""
    price = F.col(price) if isinstance(price, str) else price
    exact = price.cast("double") * 100
    whole = F.floor(exact + 0.5)
    good = (F.abs(exact) <= MOST_CENTS) & (F.abs(exact - whole) < 0.05)
    wrong = F.raise_error(F.concat(F.lit("no price in whole cents: "), price.cast("string")))
    return F.when(price.isNull(), F.lit(None)).when(good, whole).otherwise(wrong)


def sum_cents(price: Column | str) -> Column:
    """First-level sum, straight from the price column."""
    return F.sum(cents(price))


def merge_cents(total: Column | str) -> Column:
    """Sum of sums over a coarser key."""
    total = F.col(total) if isinstance(total, str) else total
    return F.sum(total.cast("decimal(38,0)"))


def to_amount(total: Column | str) -> Column:
    total = F.col(total) if isinstance(total, str) else total
    return total.cast("double") / 100
