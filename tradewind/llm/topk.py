"""Exact k nearest binary codes by Hamming distance, by incremental multi-index hashing.

A code of 64 bits is cut into segments of about as many bits as tell the rows apart, and rows are found by the value of
each segment. A search looks up, with growing radius, all values that differ from the query's segment in so many bits.
When all `p` segments have been searched to radius `a`, every code within `p * (a + 1) - 1` bits has been met, since one
farther would differ in more than `a` bits in each segment. A query ends when its k-th distance is no more than that.

Spark joins the queries' values with the rows' values, one radius after another, for the queries still open. The values are
made by the query, so the files that the queries come from say nothing of their number: these joins are by a shuffle, as is
every join of this module that a file's size could make a broadcast of many rows. Queries so far from all rows that looking
up their values would cost more than comparing blocks are compared in blocks, where each pair of blocks is a task.
"""

from __future__ import annotations

from itertools import combinations, pairwise
from math import comb, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CODE_BITS = 64
# Rows that share a segment's value, were codes evenly spread, and bounds of a segment's bits.
ROWS_PER_KEY, LEAST_BITS, MOST_BITS = 64, 10, 32
# Rows of one value that a task joins; a value with more is dealt to several.
ROWS_PER_PART = 8_192
# Values that one query looks up at one radius; beyond that, rows are compared in blocks. A lookup costs about as much as
# comparing with so many rows of a block, and a few lookups always cost little.
MOST_PROBES, ROWS_PER_PROBE, FEW_PROBES = 1 << 16, 4_096, 2_048
# Of the index of a block, and values looked up there; beyond these, all rows of the block are compared.
PARTS, WIDTH = 4, 16
MOST_LOOKUPS, ROWS_PER_LOOKUP = 1 << 13, 64
ROWS_PER_BLOCK = 1_000_000
QUERIES_PER_BLOCK = 20_000
# Pairs of blocks are so many at least, unless their queries were fewer than these.
FEW_PAIRS, FEW_QUERIES = 32, 500
# Bits within which rows of a block are looked up first, if nothing is known of a query's distances.
FIRST_REACH = 11
FOUND = "query long, neighbor_id long, distance int"


def sign_codes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and code: bit i is set where number i of the vector is above 0. Rows without id or vector have no code and are
    left out; numbers that are null give 0, NaN counts as above 0, as Spark compares it. A vector of more than 64
    numbers fails the job."""
    bits = F.transform(F.col(vector), lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    code = F.when(F.size(vector) <= CODE_BITS, code).otherwise(F.raise_error(F.lit("a code has at most 64 bits")).cast("long"))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), code.alias("code"))


def segments(rows: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each segment, for an index of so many rows."""
    bits = min(max(round(log2(max(rows, 1) / ROWS_PER_KEY)), LEAST_BITS), MOST_BITS)
    n = CODE_BITS // bits
    return [(a, b - a) for a, b in pairwise(CODE_BITS * i // n for i in range(n + 1))]


def _value(code: Column, cut: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(code, cut[0]).bitwiseAND(F.lit((1 << cut[1]) - 1).cast("long"))


def _values(code: Column, cuts: list[tuple[int, int]], radius: int) -> Column:
    """Segment and value, for all values of the segments that differ from the code's in `radius` bits."""

    def near(i: int) -> Column:
        flips = ",".join(str(sum(1 << b for b in x)) for x in combinations(range(cuts[i][1]), radius))
        masks = F.split(F.lit(flips), ",").cast("array<long>")
        own = _value(code, cuts[i])
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("segment"), own.bitwiseXOR(m).alias("value")))

    return F.inline(F.flatten(F.array(*(near(i) for i in range(len(cuts))))))


def _met_first(different: Column, cuts: list[tuple[int, int]], radius: int) -> Column:
    """Whether no smaller radius and no earlier segment has met this pair; `different` has the bits where it differs."""
    met = F.least(*(F.bit_count(_value(different, c)) * len(cuts) + i for i, c in enumerate(cuts)))
    return met == F.lit(radius * len(cuts)) + F.col("segment")


def _index(kept: DataFrame, cuts: list[tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """Rows by segment, value and part, and the values that have several parts."""
    rows = kept.select("id", "code", _values(F.col("code"), cuts, 0))
    key = ["segment", "value"]
    sizes = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > ROWS_PER_PART)
    hot = written(sizes.select(*key, F.ceil(F.col("n") / ROWS_PER_PART).cast("int").alias("parts")), "hot-values")
    part = F.pmod(F.xxhash64("id", "code"), F.coalesce("parts", F.lit(1))).cast("int")
    return written(rows.join(hot, key, "left").select(*key, part.alias("part"), "id", "code"), "index"), hot


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbor_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


class Index:
    """Rows of a block by the values of their codes' parts."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        # One part after another: rows by value, their codes, and where each value starts.
        self.order = np.empty(PARTS * len(codes), dtype=np.int32)
        counts = np.empty((PARTS, 1 << WIDTH), dtype=np.int64)
        for p in range(PARTS):
            values = (codes >> np.uint64(p * WIDTH)).astype(np.uint16)
            self.order[p * len(codes) : (p + 1) * len(codes)] = np.argsort(values, kind="stable")
            counts[p] = np.bincount(values, minlength=1 << WIDTH)
        self.sorted = codes[self.order]
        self.starts = np.append(0, np.cumsum(counts))
        self.near = np.argsort(np.bitwise_count(np.arange(1 << WIDTH, dtype=np.uint32)), kind="stable")
        self.ends = [0, *np.cumsum([comb(WIDTH, a) for a in range(WIDTH + 1)]).tolist()]

    def within(self, query: int, far: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows at most `far` bits from the query, and their distances. Such a row differs in at most `(far - p) // PARTS`
        bits in one part `p` at least, since else it would differ in more than `far` bits."""
        target = np.uint64(query)
        lookups = [self.ends[min((far - p) // PARTS, WIDTH) + 1] for p in range(PARTS)]
        if sum(lookups) > min(MOST_LOOKUPS, len(self.codes) // ROWS_PER_LOOKUP):
            distances = np.bitwise_count(self.codes ^ target)
            rows = np.flatnonzero(distances <= far)
            return rows, distances[rows]
        mask = (1 << WIDTH) - 1
        values = np.concatenate([(self.near[:n] ^ (query >> (p * WIDTH) & mask)) + (p << WIDTH) for p, n in enumerate(lookups)])
        low = self.starts[values]
        n = self.starts[values + 1] - low
        skipped = np.cumsum(n)
        at = np.repeat(low - skipped + n, n)
        at += np.arange(len(at))
        differ = self.sorted[at]
        differ ^= target
        distances = np.bitwise_count(differ)
        close = np.flatnonzero(distances <= far)
        rows, first = np.unique(self.order[at[close]], return_index=True)
        return rows, distances[close[first]]

    def search(self, query: int, k: int, far: int = CODE_BITS) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest of the rows at most `far` bits away, equal distances by id; all of them if
        there are fewer."""
        reach = far if far < CODE_BITS else FIRST_REACH
        rows, distances = self.within(query, reach)
        while len(rows) < k and reach < far:
            reach = min(2 * reach, far)
            rows, distances = self.within(query, reach)
        farthest = np.searchsorted(np.cumsum(np.bincount(distances)), k)
        close = np.flatnonzero(distances <= farthest)
        rows, distances = rows[close], distances[close]
        best = np.lexsort((self.ids[rows], distances))[:k]
        return self.ids[rows[best]], distances[best].astype(np.int64)


def _in_blocks(kept: DataFrame, rows: int, asked: DataFrame, queries: int, k: int) -> DataFrame:
    """The k best of each block of rows for each query, no farther than its `far`: query, neighbor_id and distance."""
    blocks = -(-rows // ROWS_PER_BLOCK) or 1
    query_blocks = max(-(-queries // QUERIES_PER_BLOCK), min(FEW_PAIRS // blocks, queries // FEW_QUERIES)) or 1

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def own(n: int, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")

    left = kept.select("id", "code", own(blocks, "id", "code").alias("block"), all_of(query_blocks).alias("asked"))
    right = asked.select("query", "far", all_of(blocks).alias("block"), own(query_blocks, "query").alias("asked"))

    def search(part: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        index = Index(part["code"].to_numpy(np.int64).view(np.uint64), part["id"].to_numpy(np.int64))
        out = [(q, *index.search(q % (1 << 64), k, far)) for q, far in zip(wanted["query"].tolist(), wanted["far"].tolist(), strict=True)]
        return pd.DataFrame({
            "query": np.repeat(np.array([q for q, _, _ in out], dtype=np.int64), [len(i) for _, i, _ in out]),
            "neighbor_id": np.concatenate([np.zeros(0, np.int64), *(i for _, i, _ in out)]),
            "distance": np.concatenate([np.zeros(0, np.int64), *(d for _, _, d in out)]).astype(np.int32),
        })

    pair = ["block", "asked"]
    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInPandas(search, FOUND)


def nearest(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """For each row of `queries(id, code)` its k nearest rows of `codes(id, code)`: query_id, neighbor_id, distance and
    rank from 1. Equal distances are ranked by id. A query that is a row of `codes` finds itself. Repeated rows are rows of
    their own. Fewer than k rows give all of them, an empty table on either side none. A null id or code is no row. Other
    columns don't matter.

    Of rows with equal codes only the k with the least ids can be found, so no more go to the index; equal queries are
    searched once. A value that very many rows share is dealt to several parts, and its queries go to all of them.
    """
    known = "id IS NOT NULL AND code IS NOT NULL"
    few = Window.partitionBy("code").orderBy("id")
    numbered = codes.where(known).select("id", "code", F.row_number().over(few).alias("_n"))
    kept = written(numbered.where(F.col("_n") <= k).drop("_n"), "codes")
    named = queries.where(known).select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    asked = written(named.select("query", F.lit(CODE_BITS).alias("far")).distinct(), "queries")
    rows, left = kept.count(), asked.count()
    cuts = segments(rows)
    most, radius, full = min(rows, MOST_PROBES, max(FEW_PROBES, rows // ROWS_PER_PROBE)), 0, min(rows, k)
    done: list[DataFrame] = []
    best = None
    if left and len(cuts) <= most:
        index, hot = _index(kept, cuts)
    while left and radius <= cuts[-1][1] and sum(comb(bits, radius) for _, bits in cuts) <= most:
        probes = asked.select("query", "far", _values(F.col("query"), cuts, radius)).join(hot, ["segment", "value"], "left")
        probes = probes.select("query", "far", "segment", "value", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        different = F.col("query").bitwiseXOR(F.col("code"))
        met = probes.hint("merge").join(index, ["segment", "value", "part"]).where((F.bit_count(different) <= F.col("far")) & _met_first(different, cuts, radius))
        found = met.select("query", F.col("id").alias("neighbor_id"), F.bit_count(different).cast("int").alias("distance"))
        state = _best(found if best is None else best.unionByName(found), k)
        own = Window.partitionBy("query")
        state = state.withColumns({"n": F.count("*").over(own), "farthest": F.max("distance").over(own)})
        covered = len(cuts) * (radius + 1) - 1
        ends = (F.col("n") == full) & (F.col("farthest") <= covered)
        state = written(state.withColumn("ends", ends), "nearest")
        result = [F.col(c) for c in ("query", "neighbor_id", "distance")]
        done.append(state.where("ends").select(*result))
        best = state.where("NOT ends").select(*result)
        far = F.when(F.col("n") == full, F.col("farthest")).otherwise(CODE_BITS)
        reached = state.where("rank = 1").select("query", "ends", far.alias("far"))
        still = asked.select("query").join(reached.hint("merge"), "query", "left").where("ends IS NULL OR NOT ends")
        asked = written(still.select("query", F.coalesce("far", F.lit(CODE_BITS)).alias("far")), "queries")
        left, radius = asked.count(), radius + 1
    if left:
        done.append(_in_blocks(kept, rows, asked, left, k))
    if not done:
        done.append(codes.sparkSession.createDataFrame([], FOUND))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return named.join(_best(every, k).hint("merge"), "query").select("query_id", "neighbor_id", "distance", "rank")
