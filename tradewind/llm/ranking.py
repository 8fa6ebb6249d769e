"""Ranked search over whole texts: bundles of items go from one owner of terms to the next.

Documents are cut into shards of a bounded number of bytes, and postings (a term's documents in a shard and how often each
holds it) are stored by the term's owner. A bundle of at most `BUNDLE` items carries the sparse scores of a shard's
documents; at each owner it meets that owner's postings, whose contributions are added as integers, and it goes on to
the next one. After the last owner each bundle's best documents are chosen, first per shard, then over all.

A work unit is one bundle in one shard, so its size is bounded however many documents hold a term. Postings of terms that no
item asks for are left out by a table of `FILTER` bits, which lets a few others pass; those meet no item later.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import top_rows
from ..operators.ranks import positions
from .common import gives_back, shared_folder, text_batches, written
from .linededup import CAPITALS

# The characters between terms, all in ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BUNDLE = 256
# Text of a shard.
SHARD_BYTES = 4_000_000
FILTER = 1 << 20
# Parts that a term's postings are dealt to when they meet the items.
PARTS = 16
# Bytes of a text to bytes of terms and spaces; those above 127 belong to letters beyond ASCII.
FOLDED = bytes(b if b > 127 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else ord(chr(b).lower()) if chr(b) in CAPITALS else 32 for b in range(256))

POSTINGS = "owner int, shard long, term string, docs array<int>, counts array<int>, ids array<long>"
STATE = "shard long, bundle long, ids array<long>, sizes array<int>, places array<int>, scores array<long>"
# The owner of a shard's own row: its documents' ids and numbers of terms.
NO_TERM = -1


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of texts, A-Z made small, and for each the number of its text."""
    texts = texts.cast(pa.string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")[bounds[0] : bounds[-1]].tobytes().translate(FOLDED)
    folded = pa.StringArray.from_buffers(len(texts), pa.py_buffer((bounds - bounds[0]).tobytes()), pa.py_buffer(data))
    words = pc.ascii_split_whitespace(folded)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(words.offsets.to_numpy()))
    full = pc.greater(pc.binary_length(words.values), 0)
    return words.values.filter(full), doc[full.to_numpy(zero_copy_only=False)]


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _shard(batch: pa.RecordBatch, shard: int, wanted: np.ndarray, owners: int) -> pa.RecordBatch:
    """The postings of one shard, and its row of ids and sizes."""
    terms, doc = terms_of(batch.column("text"))
    n = batch.num_rows
    found = terms.dictionary_encode()
    crc = np.fromiter((zlib.crc32(t.as_buffer()) for t in found.dictionary), np.int64, len(found.dictionary))
    known = np.unpackbits(wanted, count=FILTER)[crc % FILTER].astype(bool)
    code = found.indices.to_numpy().astype(np.int64)
    asked = known[code]
    pair, count = np.unique(code[asked] * n + doc[asked], return_counts=True)
    code, doc_of = pair // max(n, 1), pair % max(n, 1)
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    bounds = np.append(starts, len(code))
    kinds = code[starts]
    owner = np.append((crc[kinds] >> 20) % owners, NO_TERM)
    own = batch.column("doc_id").cast(pa.int64())
    rows = len(kinds) + 1
    columns = [
        pa.array(owner, pa.int32()),
        pa.array(np.full(rows, shard), pa.int64()),
        pa.concat_arrays([found.dictionary.take(pa.array(kinds)), pa.nulls(1, pa.string())]),
        _lists(doc_of, np.append(bounds, bounds[-1]), pa.int32()),
        _lists(np.append(count, np.bincount(doc, minlength=n)), np.append(bounds, bounds[-1] + n), pa.int32()),
        pa.ListArray.from_arrays(pa.array(np.append(np.zeros(rows, np.int32), n), pa.int32()), own),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["owner", "shard", "term", "docs", "counts", "ids"])


def write_postings(docs: DataFrame, path: str, terms: DataFrame, owners: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Postings of `docs(doc_id, text)` for the terms of `terms(term)`, by owner, and per shard its ids and sizes.

    At most `FILTER` numbers of the terms' checksums reach the driver and the tasks.
    """
    bits = np.zeros(FILTER, bool)
    bits[[r[0] for r in terms.select(F.crc32(F.col("term").cast("binary")) % FILTER).distinct().collect()]] = True
    wanted = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(text_batches(batches, shard_bytes)):
            if batch.num_rows:
                yield _shard(batch, first + i, wanted.value, owners)

    docs.select("doc_id", "text").mapInArrow(gives_back(index), POSTINGS).write.partitionBy("owner").parquet(path)


def _add(left: pa.Table, right: pa.Table, n_docs: int, n_terms: int) -> pa.Table:
    """One bundle in one shard after an owner: `right` holds that owner's postings and the items that ask for them."""
    row = left.combine_chunks()
    sizes = row.column("sizes").chunk(0).values.to_numpy().astype(np.int64)
    n = len(sizes)
    norms = 12 * (100 - 25 + 25 * sizes * n_docs // max(n_terms, 1))
    scores = np.zeros(BUNDLE * n, np.int64)
    scores[row.column("places").chunk(0).values.to_numpy()] = row.column("scores").chunk(0).values.to_numpy()
    if right.num_rows:
        docs, counts = (right.column(c).combine_chunks() for c in ("docs", "counts"))
        bounds = docs.offsets.to_numpy()
        docs, counts = docs.values.to_numpy(), counts.values.to_numpy().astype(np.int64)
        gains = 1_000_000_000 * counts // (1000 * counts + norms[docs])
        asked = (right.column(c).to_pylist() for c in ("weight", "items", "repeats"))
        for a, b, weight, items, repeats in zip(bounds[:-1], bounds[1:], *asked, strict=True):
            doc, gain = docs[a:b], weight * gains[a:b]
            for item, often in zip(items, repeats, strict=True):
                scores[item * n + doc] += gain * often  # a term's documents are all different
    places = np.flatnonzero(scores)
    whole = np.array([0, len(places)])
    row = row.set_column(4, "places", _lists(places, whole, pa.int32()))
    return row.set_column(5, "scores", _lists(scores[places], whole, pa.int64()))


def _best(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of each item in a shard: highest score, then lowest doc_id, null first."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column("ids")[i].values
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            number = ids.fill_null(0).to_numpy()
            places, scores = (batch.column(c)[i].values.to_numpy() for c in ("places", "scores"))
            item = places // max(len(ids), 1)
            chosen = []
            for a, b in zip(*(lambda x: (x[:-1], x[1:]))(np.searchsorted(item, np.arange(BUNDLE + 1))), strict=True):
                own, least = scores[a:b], 0
                if len(own) > k:
                    least = np.partition(own, len(own) - k)[len(own) - k]
                at = a + np.flatnonzero(own >= least)
                doc = places[at] % len(ids)
                chosen.append(at[np.lexsort((number[doc], known[doc], -scores[at]))][:k])
            at = np.concatenate(chosen)
            first = batch.column("bundle")[i].as_py() * BUNDLE
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + item[at], pa.int64()), ids.take(pa.array(places[at] % max(len(ids), 1))), pa.array(scores[at])],
                names=["item", "doc_id", "score"],
            )


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, owners: int = 4, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The `k` documents of `docs(doc_id, text)` with the highest scores above 0 for each row of `items(item_id, text)`:
    item_id, item (a number of the row), rank from 1, doc_id, score. Equal scores stand by ascending doc_id, null first.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z made small; a text that is null or has none is no
    document of the counts and never found, and such an item finds nothing. Rows that share an id, or are equal, are
    documents and items of their own. Other columns are ignored; empty tables give an empty one. A very long text is a
    shard by itself.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "ranking")
    numbered = positions(items.select("item_id", "text"), ["item_id", "text"], f"{folder}/items", "item")
    folded = F.translate("text", CAPITALS, CAPITALS.lower())
    asked = numbered.select("item", F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term"))
    asked = written(asked.groupBy("term", "item").agg(F.count(F.lit(1)).alias("repeats")), "item-terms")
    write_postings(docs, f"{folder}/postings", asked.select("term"), owners, shard_bytes)

    def postings(which: Column) -> DataFrame:
        return spark.read.schema(POSTINGS).parquet(f"{folder}/postings").where(which)

    shards = postings(F.col("owner") == NO_TERM)
    full = F.size(F.filter("counts", lambda n: n > 0)).cast("long")
    terms = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    totals = shards.agg(F.coalesce(F.sum(full), F.lit(0)).alias("docs"), F.coalesce(F.sum(terms), F.lit(0)).alias("terms")).first()

    held = postings(F.col("owner") != NO_TERM).groupBy("owner", "term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(totals.docs) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    bundle = F.expr(f"item div {BUNDLE}").alias("bundle")
    wanted = asked.join(held, "term").groupBy("owner", "term", bundle, weight.alias("weight")).agg(
        F.collect_list((F.col("item") % BUNDLE).cast("int")).alias("items"), F.collect_list("repeats").alias("repeats")
    )  # at most BUNDLE items each
    wanted = written(wanted.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), "item-weights")

    bundles = numbered.agg(F.max(bundle)).first()[0]
    every = F.sequence(F.lit(0).cast("long"), F.lit(-1 if bundles is None else bundles).cast("long"))
    none = F.array()
    state = shards.where(F.lit(bundles is not None)).select(
        "shard", F.explode(every).alias("bundle"), "ids", F.col("counts").alias("sizes"),
        none.cast("array<int>").alias("places"), none.cast("array<long>").alias("scores"),
    )
    add = partial(_add, n_docs=totals.docs, n_terms=totals.terms)
    for owner in range(owners):
        own = postings(F.col("owner") == owner).withColumn("part", F.pmod(F.xxhash64("shard"), F.lit(PARTS)).cast("int"))
        met = own.join(wanted.where(F.col("owner") == owner).drop("owner"), ["term", "part"])
        met = met.select("shard", "bundle", "docs", "counts", "weight", "items", "repeats")
        keys = ["shard", "bundle"]
        state = state.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(lambda a, b: add(a, b), STATE)
    found = state.mapInArrow(partial(_best, k=k), "item long, doc_id long, score long")
    best = top_rows(found, ["item"], "score", k, tie_break=["doc_id"], position="rank")
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "item", "rank", "doc_id", "score")
