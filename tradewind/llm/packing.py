"""Best-fit packing of token sequences into blocks of a fixed length, by exact-complement hashing.

Which lengths share a block depends only on how many pieces there are of each length. Spark counts those, at most
`capacity` rows; the driver fits that table of counts into block patterns; and each piece finds its place from its
length and its rank among the pieces of that length. No piece passes through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ENCODE_BYTES, gives_back, running_totals, text_batches, written
from .tokens import word_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


class Pattern(NamedTuple):
    """`blocks` blocks, each filled with (length, how many) in this order."""

    blocks: int
    fill: tuple[tuple[int, int], ...]


def _fit(gap: int, counts: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three lengths on hand that fill the gap exactly, found by their sums; long ones first."""
    if counts[gap] > 0:
        return (gap,)

    def pair(total: int, longest: int, taken: int = 0) -> tuple[int, int] | None:
        a = np.arange(min(longest, total - 1), (total - 1) // 2, -1)
        left = counts.copy() if taken else counts
        if taken:
            left[taken] -= 1
        good = (left[a] > 0) & (left[total - a] > np.where(2 * a == total, 1, 0))
        return (int(a[i]), int(total - a[i])) if len(a) and good[i := int(good.argmax())] else None

    if found := pair(gap, gap - 1):
        return found
    for a in np.flatnonzero(counts[: max(gap - 1, 0)])[::-1].tolist():
        if 3 * a < gap:
            return None
        if found := pair(gap - a, a, a):
            return (a, *found)
    return None


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up the counts: exact fillings first, longest length first, then best fit.

    Each exact pattern is used as often as its lengths last, so it leaves fewer of one of them than it needs; and each
    step of the best fit ends a length or a group of equal blocks. So there are a few patterns a length, however many
    pieces there are.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    done: list[Pattern] = []
    rest: list[tuple[int, int]] = []
    if left[capacity]:
        done.append(Pattern(int(left[capacity]), ((capacity, 1),)))
        left[capacity] = 0
    for longest in range(capacity - 1, 0, -1):
        while left[longest]:
            left[longest] -= 1
            found = _fit(capacity - longest, left)
            left[longest] += 1
            if not found:
                rest.append((longest, int(left[longest])))
                left[longest] = 0
                break
            fill = {x: (longest, *found).count(x) for x in (longest, *found)}
            n = min(int(left[x]) // k for x, k in fill.items())
            for x, k in fill.items():
                left[x] -= n * k
            done.append(Pattern(n, tuple(fill.items())))
    return done + _best_fit(rest, capacity)


def _best_fit(rest: list[tuple[int, int]], capacity: int) -> list[Pattern]:
    """Lengths in falling order, each into the smallest gap that holds it; equal blocks are kept as one group."""
    gaps: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for length, n in rest:
        gap = length
        while n:
            while gap < capacity and not gaps[gap]:
                gap += 1
            each = min(gap // length, n)
            old = gaps[gap].pop() if gap < capacity else Pattern(n // each, ())
            used = min(old.blocks, n // each)
            if used < old.blocks:
                gaps[gap].append(Pattern(old.blocks - used, old.fill))
            gaps[gap - each * length].append(Pattern(used, (*old.fill, (length, each))))
            n -= used * each
    return [p for group in gaps for p in group]


class Places:
    """Block and offset of a piece by its length and its rank among those of that length."""

    def __init__(self, patterns: list[Pattern]):
        rows, ranks, block = [], {}, 0
        for p in patterns:
            offset = 0
            for length, each in p.fill:
                first = ranks.get(length, 0)
                rows.append((length, first, each, block, offset))
                ranks[length] = first + p.blocks * each
                offset += length * each
            block += p.blocks
        rows.sort()
        self.length, self.first, self.each, self.block, self.offset = np.array(rows, dtype=np.int64).reshape(-1, 5).T
        self.blocks = block

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(length):
            return length, length
        lengths, starts = np.unique(self.length, return_index=True)
        # Search each length's own ranges: order by (length, first) as one number.
        step = int(max(self.first.max(), rank.max())) + 1
        code = np.searchsorted(lengths, self.length) * step + self.first
        at = np.searchsorted(code, np.searchsorted(lengths, length) * step + rank, side="right") - 1
        nth = rank - self.first[at]
        return self.block[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Token pieces of `docs(doc_id, text)`: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its text's ids and `end_id`; a null text counts as empty. One longer than `capacity` is cut from its
    end, so that only its first piece may be shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(tokenizer, False), end_id.to_bytes(4, "little")
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                            ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for batch in text_batches(batches, ENCODE_BYTES):
            rows = []
            ids = encoder.encode(batch.column("text"))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                own += end
                n = len(own) // 4
                first = n % capacity or capacity
                bounds = [0, *range(min(first, n), n + 1, capacity)]
                for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    part = own[4 * a : 4 * b]
                    rows.append((doc_id, i, a, b - a, zlib.crc32(part), np.frombuffer(part, "<i4") if with_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(gives_back(cut), PIECES)


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add to each piece its block, `sequence_id`, and its `offset` there. `parts` holds doc_id, piece, start, length
    (1 to `capacity`) and ids_crc32; it is read three times, so it should be a written table.

    Repeated rows are packed like any others. An empty table gives an empty one.
    """
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = parts.sparkSession.sparkContext.broadcast(Places(plan(counts, capacity)))  # a few rows per length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            found = places.value.find(length, rank)
            rest = batch.drop_columns(["_rank"])
            for name, values in zip(("sequence_id", "offset"), found, strict=True):
                rest = rest.append_column(name, pa.array(values, pa.int64()))
            yield rest

    order = ["doc_id", "piece", "start", "ids_crc32"]
    ranked = running_totals(parts.drop("_rank"), ["length"], order, {"_rank": F.lit(1)})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema if f.name != "_rank")
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """Pieces of whole documents with their places, without ids."""
    return pack(written(pieces(docs, tokenizer, end_id, capacity).drop("ids"), "pieces"), capacity)


def blocks(parts: DataFrame) -> DataFrame:
    """The packed blocks: sequence_id and its ids in order. `parts` is a packed table with ids."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(rows, lambda r: r["ids"])).alias("ids"))
