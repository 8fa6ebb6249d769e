"""Joins of many rows with few."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts that the rows of one key are dealt to.
PARTS = 32


def match_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is in a frame of unique keys. Null keys match nothing.

    For a ``df`` with few rows per key, such as sums. Null-safe equality is used because Spark copies
    a filter on one side of a plain equality to the other side. There it would land below the
    aggregate that found the keys, which then could not share its shuffle.
    """
    name = keys.columns[0]
    wanted = keys.filter(F.col(name).isNotNull()).select(F.col(name).alias(f"_{name}"))
    return df.join(wanted, df[key].eqNullSafe(wanted[f"_{name}"])).select(*df.columns)


def by_shuffle(df: DataFrame) -> DataFrame:
    """The rows for a join that both sides are shuffled for, at any size.

    For stored tables with a row per order, product, customer or seller. Spark takes the size of the files for that of the
    rows, but ids in order compress to a byte or two: a few MB of files are millions of rows, and those would be broadcast
    through the driver.
    """
    return df.hint("merge")


def join_spread(df: DataFrame, few: DataFrame, keys: Sequence[str], *, parts: int = PARTS) -> DataFrame:
    """Inner join of any number of rows with one row per key; null keys match each other.

    The rows of a key are dealt by a hash of the whole row, and the row of ``few`` is repeated for
    each part, so the rows of one key never meet in one task.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(parts)).alias("_part")
    others = [F.col(c) for c in few.columns if c not in keys]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("_few_part")
    few = few.select(*(F.col(k).alias(f"_few_{k}") for k in keys), *others, every)
    dealt = df.select("*", part)
    same = reduce(lambda a, b: a & b, (dealt[k].eqNullSafe(few[f"_few_{k}"]) for k in keys))
    joined = dealt.join(few, same & (dealt["_part"] == few["_few_part"]))
    return joined.select(*df.columns, *others)
