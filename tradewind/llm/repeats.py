"""Removal of long byte strings that occur more than once in a corpus, by suffix arrays of shards.

Every window of `LENGTH` bytes has an anchor: the `GRAM` bytes in it with the least hash, the leftmost of these. Equal
windows have equal anchors at the same place, so windows need be compared only where anchors are equal. The
windows of a text that share an anchor follow one another; the bytes they cover are a stretch. Each window belongs to
one stretch.

1. Tasks cut texts into stretches: anchor hash, stretch hash, and where it lies.
2. Sorted by these, equal stretches stand together: windows of such a stretch are repeated. Stretches that have an
   anchor in common, but differ, go on, one of each kind, if one of them occurs once.
3. They are brought together by anchor in shards. A shard's suffix array, by induced sorting, puts equal windows side by
   side; the common prefix of each suffix, in text order, with the one before it in the array is tested for `LENGTH`.
4. The repeated windows of a text are united and removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gives_back, set_aside, text_batches, written
from .suffixes import powers, suffix_order

LENGTH = 200
GRAM = 64
# Bytes of text worked on at a time; windows of a longer text are taken piece by piece.
PIECE = 500_000
# Bytes of a shard's array. An anchor with more is left to hashes of single windows, which any number of tasks count.
SHARD = 1_500_000
# Bits for the place of an anchor in the text worked on, below those of its hash.
PLACE = np.uint64(28)

STRETCHES = "anchor long, stretch long, id_key long, text_key long, start long, windows long"
OUTCOMES = f"{STRETCHES}, repeated boolean"
MARKS = "id_key long, text_key long, start long, stop long"


def _keyed(docs: DataFrame) -> DataFrame:
    """With the two keys of a text: rows that share both hold the same text, so what holds of one holds of the other."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"id_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "text_key": F.xxhash64(text)})


def _gram_hashes(data: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    n = len(data)
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[:n]))
    h = (sums[GRAM:] - sums[:-GRAM]) * up[: n - GRAM + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def stretches(data: bytes, ends: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts one after another, `ends` holding for each byte where its text ends: each stretch's anchor, hash, first
    window and number of windows."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    h = _gram_hashes(np.frombuffer(data, np.uint8), up, down)
    grams, windows = LENGTH - GRAM + 1, len(data) - LENGTH + 1
    least, k = (h >> PLACE << PLACE) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * k <= grams:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    least = np.minimum(least[:windows], least[grams - k : grams - k + windows])
    place = (least & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    whole = np.arange(windows) + LENGTH <= ends[:windows]
    new = np.append(True, (place[1:] != place[:-1]) | (whole[1:] != whole[:-1]) | (ends[1:windows] != ends[: windows - 1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, windows))
    first, count = first[whole[first]], count[whole[first]]
    at = place[first]
    digest = xxhash.xxh3_64_intdigest
    bounds = zip(first.tolist(), (first + count + LENGTH - 1).tolist(), (at - first).tolist(), strict=True)
    hashes = np.array([digest(data[a:b], seed) for a, b, seed in bounds], dtype=np.uint64)
    return h[at].view(np.int64), hashes.view(np.int64), first, count


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up, down = powers(2 * PIECE + LENGTH)
    for batch in text_batches(batches, PIECE):
        rows: list[tuple[int, int, bytes]] = []
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        for i, text in enumerate(texts):
            rows += [(i, s, text[s : s + PIECE + LENGTH - 1]) for s in range(0, max(len(text) - LENGTH + 1, 0), PIECE)]
        ids, keys = (batch.column(c).to_numpy() for c in ("id_key", "text_key"))
        for own in [rows] if sum(len(x[2]) for x in rows) <= 2 * PIECE else [[x] for x in rows]:
            sizes = np.array([len(x[2]) for x in own], dtype=np.int64)
            stops = np.cumsum(sizes)
            anchor, stretch, first, count = stretches(b"".join(x[2] for x in own), np.repeat(stops, sizes), up, down)
            piece = np.searchsorted(stops, first, side="right")
            row, offset = (np.array([x[c] for x in own], dtype=np.int64)[piece] for c in (0, 1))
            start = first - (stops - sizes)[piece] + offset
            columns = {"anchor": anchor, "stretch": stretch, "id_key": ids[row], "text_key": keys[row], "start": start, "windows": count}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()})


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by anchor and stretch: those of equal stretches come out as repeated, and of stretches that must be
    compared one of each kind does, a second time if it is repeated. What may go on in another batch counts as to be
    compared, so a batch is settled by itself."""
    for batch in batches:
        if not len(batch):
            continue
        anchor, stretch = batch.column("anchor").to_numpy(), batch.column("stretch").to_numpy()
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new = new_anchor | np.append(True, stretch[1:] != stretch[:-1])
        kind, group = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(anchor)))
        of = group[first]
        kinds, single = np.bincount(of), np.bincount(of, weights=size == 1)
        compared = (kinds > 1) & (single > 0)
        compared[[0, -1]] = True
        repeated = size[kind] > 1
        yield batch.filter(pa.array(repeated)).append_column("repeated", pa.array(np.ones(int(repeated.sum()), bool)))
        chosen = first[compared[of]]
        yield batch.take(pa.array(chosen)).append_column("repeated", pa.array(np.zeros(len(chosen), bool)))


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, PIECE):
        rows = []
        for text, found, id_key, text_key in zip(*(batch.column(c).to_pylist() for c in ("text", "found", "id_key", "text_key")), strict=True):
            data = text.encode()
            rows += [(x["anchor"], id_key, text_key, x["start"], data[x["start"] : x["start"] + x["windows"] + LENGTH - 1]) for x in found]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "id_key", "text_key", "start", "data"]
        )


def repeated_windows(parts: list[bytes]) -> list[np.ndarray]:
    """For each byte string, which of its windows occur at another place of the strings."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    stops = np.cumsum(sizes + 1)
    codes, text = np.unique(np.frombuffer(b"\0".join(parts) + b"\0", np.uint8), return_inverse=True)
    text = (text + 2).astype(np.int32)
    text[stops - 1] = 1  # between strings
    text = np.append(text, 0).astype(np.uint8 if len(codes) + 2 <= 256 else np.uint16)
    order = suffix_order(text, len(codes) + 2, LENGTH)
    left = np.append(np.repeat(stops - 1, sizes + 1), 0) - np.arange(len(text))
    order = order[left[order] >= LENGTH]
    del left
    before = np.full(len(text), -1, dtype=np.int32)  # the suffix before each one, in text order
    before[order[1:]] = order[:-1]
    up, down = powers(len(text))
    sums = np.append(np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * down[: len(text)]))
    at = np.flatnonzero(before >= 0)
    hashes = (sums[LENGTH:] - sums[:-LENGTH]) * up[: len(text) - LENGTH + 1] if len(text) >= LENGTH else sums[:0]
    del up, down, sums
    at = at[hashes[at] == hashes[before[at]]]
    rows = np.lib.stride_tricks.sliding_window_view(text, LENGTH) if len(at) else None
    found = np.zeros(len(text), dtype=bool)
    for i in range(0, len(at), 20_000):
        own = at[i : i + 20_000]
        own = own[(rows[own] == rows[before[own]]).all(1)]
        found[own] = True
        found[before[own]] = True
    return [found[stop - 1 - size : stop - 1] for stop, size in zip(stops.tolist(), sizes.tolist(), strict=True)]


def _runs(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
    return np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by anchor: the repeated windows of each shard as marks. Anchors with more than `SHARD` bytes come out
    as they are, with their bytes."""
    names = ["anchor", "id_key", "text_key", "start", "stop", "data"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "data" else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)

    def marks(rows: list[tuple]) -> pa.RecordBatch:
        found = []
        for (_, id_key, text_key, start, _), own in zip(rows, repeated_windows([r[4] for r in rows]), strict=True):
            for a, b in zip(*(x.tolist() for x in _runs(own)), strict=True):
                found.append((None, id_key, text_key, start + a, start + b + LENGTH - 1, None))
        return out(found)

    shard: list[tuple] = []  # whole groups
    group: list[tuple] = []
    used = size = 0  # their bytes
    large = False
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "id_key", "text_key", "start", "data")), strict=True):
            if group and row[0] != group[0][0]:
                if large:
                    yield out([(*r[:4], None, r[4]) for r in group])
                elif len(group) > 1:
                    if used + size > SHARD and shard:
                        yield marks(shard)
                        shard, used = [], 0
                    shard += group
                    used += size
                group, size, large = [], 0, False
            group.append(row)
            size += len(row[4])
            if size > SHARD:
                large = True
                yield out([(*r[:4], None, r[4]) for r in group[:-1]])
                group, size = group[-1:], len(row[4])
    if large:
        yield out([(*r[:4], None, r[4]) for r in group])
    elif len(group) > 1:
        shard += group
    if shard:
        yield marks(shard)


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of byte strings by itself, with 128 bits of hash."""
    for batch in batches:
        for row in range(len(batch)):
            data = batch.column("data")[row].as_py()
            digests = [xxhash.xxh3_128_digest(data[i : i + LENGTH]) for i in range(len(data) - LENGTH + 1)]
            yield pa.RecordBatch.from_pydict(
                {
                    "window": pa.array(digests, pa.binary()),
                    **{c: pa.array([batch.column(c)[row].as_py()] * len(digests), pa.int64()) for c in ("id_key", "text_key")},
                    "start": pa.array([batch.column("start")[row].as_py() + i for i in range(len(digests))], pa.int64()),
                }
            )


def marks(keyed: DataFrame) -> DataFrame:
    """Repeated spans of the texts of `keyed(id_key, text_key, text)`: id_key, text_key, start, stop. Spans overlap."""
    cut = written(keyed.select("id_key", "text_key", "text").mapInArrow(gives_back(_cut), STRETCHES), "stretches")
    # Ranges of all columns: a common anchor, or a stretch in very many copies, is dealt to several tasks.
    order = ["anchor", "stretch", "id_key", "text_key", "start"]
    settled = written(cut.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(gives_back(_settle), OUTCOMES), "settled")
    copies = settled.where("repeated").select("id_key", "text_key", "start", (F.col("start") + F.col("windows") + LENGTH - 1).alias("stop"))
    asked = settled.where("NOT repeated").groupBy("id_key", "text_key").agg(F.collect_list(F.struct("anchor", "start", "windows")).alias("found"))
    texts = keyed.select("id_key", "text_key", "text").join(asked, ["id_key", "text_key"])
    fetched = texts.mapInArrow(gives_back(_fetch), "anchor long, id_key long, text_key long, start long, data binary")
    dealt = fetched.repartition("anchor").sortWithinPartitions("anchor")
    compared = written(dealt.mapInArrow(gives_back(_compare), "anchor long, id_key long, text_key long, start long, stop long, data binary"), "compared")
    single = compared.where("anchor IS NOT NULL").mapInArrow(_single_windows, "window binary, id_key long, text_key long, start long")
    often = single.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    hot = single.join(often, "window").select("id_key", "text_key", "start", (F.col("start") + LENGTH).alias("stop"))
    return copies.unionByName(compared.where("anchor IS NULL").select(*copies.columns)).unionByName(hot)


def _kept(text: str | None, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """The bytes that remain, how many go, and in how many runs."""
    data = (text or "").encode()
    if not spans:
        return data, 0, 0
    gone = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(gone, [s["start"] for s in spans], 1)
    np.add.at(gone, [s["stop"] for s in spans], -1)
    gone = np.cumsum(gone)[:-1] > 0
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), len(_runs(gone)[0])


def _marked(docs: DataFrame) -> DataFrame:
    keyed = _keyed(docs)
    spans = marks(keyed).groupBy("id_key", "text_key").agg(F.collect_set(F.struct("start", "stop")).alias("_spans"))
    return keyed.join(spans, ["id_key", "text_key"], "left")


def removals(docs: DataFrame) -> DataFrame:
    """Per row of `docs(doc_id, text)`: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Each byte is removed that lies in a string of `LENGTH` bytes that starts anywhere else too, in the same text or
    another. A null text counts as empty. Repeated rows count as texts of their own, so texts of `LENGTH` bytes or more
    that occur twice are removed whole.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = [_kept(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True)]
            columns = [
                batch.column("doc_id").cast(pa.int64()),
                pa.array([len(k) + n for k, n, _ in rows], pa.int64()),
                pa.array([n for _, n, _ in rows], pa.int64()),
                pa.array([n for _, _, n in rows], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in rows]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = _marked(docs.select("doc_id", "text")).select("doc_id", "text", "_spans")
    return found.mapInArrow(gives_back(digest), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with repeated strings removed from their texts; bytes of a character that is cut go with it.
    `n_chars`, if there, is counted anew. Null texts stay null. Other columns may have any names."""
    plain = set_aside(docs, ("doc_id", "text", "n_chars"))
    names = plain.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            texts = batch.column("text").to_pylist()
            left = [None if t is None else _kept(t, s)[0].decode(errors="ignore") for t, s in zip(texts, batch.column("_spans").to_pylist(), strict=True)]
            columns = {c: batch.column(c) for c in names} | {"text": pa.array(left, batch.column("text").type)}
            if "n_chars" in names:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in left], batch.column("n_chars").type)
            yield pa.RecordBatch.from_pydict(columns)

    return _marked(plain).select(*names, "_spans").mapInArrow(gives_back(clean), plain.schema).toDF(*docs.columns)
