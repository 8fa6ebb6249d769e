"""Near-duplicates by SimHash fingerprints, found by anchor-point covering.

A fingerprint is cut into three parts; of two fingerprints at four or fewer bits apart, some part differs in one bit at
most. The anchors of a part form a covering code: a Hamming code on fifteen bits, each bit for itself on the others, so
each value lies within one bit of an anchor, its home. Every fingerprint is sent to all anchors within the covering
radius and that one bit, two bits, of its parts, so it meets any fingerprint linked to it at the latter's home, and is
compared with those at home there only. Equal fingerprints are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import gives_back, set_aside, text_batches, written
from .components import components

SEED = 42
PARTS = ((0, 21), (21, 21), (42, 22))
CODE_BITS = 15
# Fingerprints that meet at one anchor in one task; more are cut into pairs of groups of that size.
GROUP = 8192
PAIRS = 4_000_000


def hash_texts(texts: list[str], shingle: int) -> np.ndarray:
    """Fingerprints of texts as unsigned numbers."""
    values: list[int] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        last = ends[min(shingle, len(words)) - 1 :]
        values += [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), last.tolist(), strict=False)]
        sizes[i] = len(last)
    out = np.zeros(len(texts), dtype=np.uint64)
    full = sizes > 0
    if full.any():
        bits = np.unpackbits(np.array(values, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        stops = np.cumsum(sizes)
        sums = np.add.reduceat(bits, (stops - sizes)[full], axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * sums > sizes[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """The rows of `docs` with `_fingerprint`, a 64-bit number; 0 for texts that are null or have no words."""
    names = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = hash_texts([t or "" for t in batch.column("text").to_pylist()], shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*names, "_fingerprint"])

    return docs.mapInArrow(gives_back(add), StructType([*docs.schema.fields, StructField("_fingerprint", LongType())]))


def _syndrome(words: np.ndarray) -> np.ndarray:
    found = np.zeros_like(words)
    for i in range(CODE_BITS):
        found ^= np.where(words >> i & 1, i + 1, 0)
    return found


def _flip(words: np.ndarray, place: np.ndarray) -> np.ndarray:
    """With bit number `place`, from 1, turned; 0 turns none."""
    return words ^ np.where(place > 0, np.int64(1) << np.maximum(place - 1, 0), 0)


def homes(part: np.ndarray) -> np.ndarray:
    """The anchor nearest to each value of a part."""
    return _flip(part, _syndrome(part & ((1 << CODE_BITS) - 1)))


def anchors_near(part: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors within two bits of each value: positions in `part`, and anchors."""
    rows, here = np.arange(len(part)), _syndrome(part & ((1 << CODE_BITS) - 1))
    at, found = [rows], [homes(part)]
    for i in range(1, CODE_BITS + 1):  # two bits of the code
        j = here ^ i
        good = (here > 0) & (j > i)
        at.append(rows[good])
        found.append(_flip(_flip(part, np.full_like(part, i)), j)[good])
    exact = [1 << i for i in range(CODE_BITS, width)]
    for i, bit in enumerate(exact):  # one other bit, then at most one of the code, or a second other one
        at.append(rows)
        found.append(homes(part) ^ bit)
        for other in exact[:i]:
            at.append(rows[here == 0])
            found.append(part[here == 0] ^ bit ^ other)
    return np.concatenate(at), np.concatenate(found)


def _part(prints: np.ndarray, part: int | np.ndarray) -> np.ndarray:
    start, width = (np.array(x)[part] for x in zip(*PARTS, strict=True))
    return (prints.view(np.uint64) >> np.asarray(start).astype(np.uint64)).astype(np.int64) & ((np.int64(1) << np.asarray(width).astype(np.int64)) - 1)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), 20_000):
            prints = batch.column("_fingerprint")[start : start + 20_000].to_numpy()
            for p, (_, width) in enumerate(PARTS):
                at, found = anchors_near(_part(prints, p), width)
                yield pa.RecordBatch.from_pydict({"anchor": found | p << 22, "_fingerprint": prints[at]})


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the components of a few links: each node that isn't the least of its component, with that."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def _links(anchor: np.ndarray, prints: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of the same anchor, rows being ordered by it: those at home with all."""
    starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    sizes = np.diff(np.append(starts, len(anchor)))
    group = np.repeat(np.arange(len(starts)), sizes)
    own = np.flatnonzero(home)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    counts = sizes[group[own]]
    ends = np.cumsum(counts)
    i = 0
    while i < len(own):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, side="right")))
        n = counts[i:j]
        left = np.repeat(own[i:j], n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[group[own[i:j]]], n)
        a, b = prints[left], prints[right]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= bits
        near &= a != b
        a, b = _roots(a[near], b[near])
        found_a.append(a)
        found_b.append(b)
        i = j
    return _roots(np.concatenate(found_a), np.concatenate(found_b))


def _compare(bits: int, most: int | None, columns: list[str]):
    """Links within the groups of rows ordered by `columns`. A group of more than `most` rows is passed on instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray, anchor: np.ndarray | None = None) -> pa.RecordBatch:
            anchors = pa.nulls(len(a), pa.int64()) if anchor is None else pa.array(anchor)
            return pa.RecordBatch.from_arrays([anchors, pa.array(a), pa.array(b)], names=["anchor", "a", "b"])

        def whole(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keys, prints = rows[:-1], rows[-1]
            if not len(prints):
                return
            new = np.append(True, np.any([k[1:] != k[:-1] for k in keys[:3]], axis=0))
            group = np.cumsum(new) - 1
            if most is not None:
                big = np.bincount(group)[group] > most
                if big.any():
                    yield out(prints[big], prints[big], keys[0][big])
                    keys, prints, group = [k[~big] for k in keys], prints[~big], group[~big]
            home = homes(_part(prints, keys[0] >> 22)) == keys[0] & ((1 << 22) - 1)
            if len(keys) > 1:  # group i of those at home against group j
                home &= keys[3] == 1
            yield out(*_links(group, prints, home, bits))

        rest: list[np.ndarray] | None = None
        passed = None  # the key of a large group whose rows are passed on as they come
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in columns]
            if passed is not None:
                stop = int(np.searchsorted(rows[0], passed, side="right"))
                yield out(rows[-1][:stop], rows[-1][:stop], rows[0][:stop])
                rows = [r[stop:] for r in rows]
                if not len(rows[0]):
                    continue
                passed = None
            rows = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            same = np.all([k == k[-1] for k in rows[: 1 if len(columns) == 2 else 3]], axis=0)
            last = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            yield from whole([r[:last] for r in rows])
            rest = [r[last:] for r in rows]
            if most is not None and len(rest[0]) > most:
                passed = rest[0][0]
                yield out(rest[-1], rest[-1], rest[0])
                rest = None
        if rest is not None:
            yield from whole(rest)

    return run


def links(prints: DataFrame, bits: int = 4, group: int = GROUP) -> DataFrame:
    """Links between the different fingerprints of `prints(_fingerprint)` that join all those at `bits` (4 at most) or
    fewer apart: a, b. Not all pairs: a chain of links joins any such pair."""
    if bits > 4:
        raise ValueError("the parts and anchors cover four bits")
    kinds = "anchor long, a long, b long"
    spread = prints.select("_fingerprint").mapInArrow(_spread, "anchor long, _fingerprint long")
    dealt = spread.repartition("anchor").sortWithinPartitions("anchor")
    found = written(dealt.mapInArrow(gives_back(_compare(bits, group, ["anchor", "_fingerprint"])), kinds), "links")
    # Large groups: each cut by a hash into parts of about `group`, and every part at home met by every part.
    large = found.where("anchor IS NOT NULL").select("anchor", F.col("a").alias("_fingerprint"))
    sizes = large.groupBy("anchor").agg(F.ceil(F.count("*") / group).cast("long").alias("n"))
    cut = large.join(sizes, "anchor").withColumn("own", F.pmod(F.xxhash64("_fingerprint"), "n"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    at_home = cut.select("anchor", F.col("own").alias("i"), every.alias("j"), F.lit(1).cast("long").alias("h"), "_fingerprint")
    others = cut.select("anchor", every.alias("i"), F.col("own").alias("j"), F.lit(0).cast("long").alias("h"), "_fingerprint")
    keys = ["anchor", "i", "j"]
    pairs = at_home.unionByName(others).repartition(*keys).sortWithinPartitions(*keys)
    more = pairs.mapInArrow(_compare(bits, None, [*keys, "h", "_fingerprint"]), kinds)
    return found.where("anchor IS NULL").select("a", "b").unionByName(more.select("a", "b"))


def classes(printed: DataFrame, bits: int = 4) -> DataFrame:
    """Per different fingerprint of `printed(doc_id, _fingerprint)`: `component`, the least fingerprint reachable by
    links, `component_id`, the least doc_id in its component, and `keeper`, whether it holds the document to keep, with
    `keep_id`, that document's id. Null ids count only where a component has no other."""
    kept = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_fingerprint").alias("print")))
    prints = written(printed.groupBy("_fingerprint").agg(kept.alias("least")), "prints")
    roots = components(links(prints, bits)).select(F.col("node").alias("_fingerprint"), "root")
    rooted = prints.join(roots, "_fingerprint", "left").withColumn("component", F.coalesce("root", "_fingerprint"))
    best = rooted.groupBy("component").agg(F.min("least").alias("best"))
    return rooted.join(best, "component").select(
        "_fingerprint", "component", F.col("best.id").alias("component_id"), (F.col("best.print") == F.col("_fingerprint")).alias("keeper"), F.col("best.id").alias("keep_id")
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """Per row of `docs(doc_id, text)`: doc_id, fingerprint (16 hex digits) and component_id, the least doc_id
    reachable by links, null if none has an id. Rows with equal fingerprints are linked, repeated rows too."""
    printed = written(with_fingerprints(docs.select("doc_id", "text"), shingle).drop("text"), "fingerprints")
    found = printed.join(classes(printed, bits), "_fingerprint")
    return found.select("doc_id", F.lpad(F.lower(F.hex("_fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """One row of each component of `docs`, that with the least doc_id, with all its columns, whatever their names. Of rows
    that share this id and the fingerprint, that with the least hash of its text, so reruns keep the same text; rows
    alike in text too are any of them. A null id counts only where a component has no other. Null and empty texts have the fingerprint 0
    and are one component; an empty table gives none. A text is hashed whole, in some
    160 bytes of memory a word.

    Texts meet their component's keeper by fingerprint and id, so a fingerprint with very many documents is dealt to all
    tasks.
    """
    plain = set_aside(docs, ("doc_id", "text"))
    printed = written(with_fingerprints(plain, shingle), "fingerprints")
    keepers = classes(printed.select("doc_id", "_fingerprint"), bits).where("keeper")
    keepers = keepers.select(F.col("_fingerprint").alias("_print"), F.col("keep_id").alias("_id"))
    own = printed.join(keepers, (F.col("_fingerprint") == F.col("_print")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    first = F.row_number().over(Window.partitionBy("_fingerprint").orderBy(F.xxhash64("text")))
    return own.withColumn("_place", first).where("_place = 1").select(*plain.columns).toDF(*docs.columns)
