"""Exact sets of ids per key as bitmaps: many small rows instead of one array per key.

Ids are numbered in the order of key and id, so those of a key stand in a row and fill few buckets of 32,768 numbers. A
set is a row per key and bucket, at most 4 KB, whatever its size. Sets are merged bucket by bucket.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_spread
from .ranks import positions

# Fixed value: the numbers of one bucket of Spark's bitmap functions.
BUCKET = 32_768


class IdSets(NamedTuple):
    """``sets``: key, ``bucket``, ``bits``. ``numbers``: member, ``number`` from 1, one row per member and key."""

    sets: DataFrame
    numbers: DataFrame
    key: str
    member: str


def id_sets(df: DataFrame, key: str, member: str, folder: str) -> IdSets:
    """The set of members of each key; null members are in no set, a null key is a key. Writes below ``folder``."""
    pairs = df.filter(F.col(member).isNotNull()).groupBy(key, member).agg(F.lit(1).alias("_one")).drop("_one")
    numbers = positions(pairs, [F.col(key).asc_nulls_first(), member], folder, "_place").withColumn("number", F.col("_place") + 1).drop("_place")
    sets = numbers.groupBy(key, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )
    return IdSets(sets, numbers, key, member)


def set_sizes(found: IdSets) -> DataFrame:
    """``key, size``: exact, from the bitmaps alone."""
    return found.sets.groupBy(found.key).agg(F.sum(F.bitmap_count("bits")).alias("size"))


def set_union(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Sets that hold what either has. Both must number members alike."""
    both = one.select(key, "bucket", "bits").unionByName(other.select(key, "bucket", "bits"))
    return both.groupBy(key, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def set_members(found: IdSets, keys: DataFrame | None = None) -> DataFrame:
    """``key, member``, a row per member; of some keys (a frame with one row per key), or of all.

    The bytes of a bitmap that hold anything are cut out first, so a small set costs little.
    """
    sets = found.sets if keys is None else join_spread(found.sets, keys.select(found.key), [found.key])
    digits = F.hex("bits")
    byte = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BUCKET // 8 - 1)), lambda i: F.substring(digits, 2 * i + 1, F.lit(2))))
    held = sets.select(found.key, "bucket", byte.alias("at", "byte")).filter("byte <> '00'")
    bit = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")
    value = F.conv("byte", 16, 10).cast("int")
    bits = held.select(found.key, "bucket", "at", value.alias("value"), bit).filter(F.getbit("value", F.col("bit")) == 1)
    number = (F.col("bucket") - 1) * BUCKET + F.col("at") * 8 + F.col("bit") + 1
    members = found.numbers.select(F.col("number").alias("_number"), found.member)
    return bits.select(found.key, number.alias("_own")).join(members, F.col("_own") == F.col("_number")).select(found.key, found.member)
