"""Token ids of whole documents as Parquet list columns, written for selective reads.

Ids and counts are delta-encoded without dictionaries, a row group holds a bounded number of bytes, and pages hold few
rows, so that the page index lets a reader of some documents skip the other pages, and a reader of counts skip the ids.
Rows stand in ascending doc_id, null first, over the files and in each file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ENCODE_BYTES, gives_back, text_batches
from .tokens import word_encoder

SCHEMA = "doc_id long, shard int, start_in_shard long, n_tokens long, ids array<int>"
ARROW = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("start_in_shard", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids", pa.list_(pa.int32()))])


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    row_group_bytes: int = 64 << 20,
    rows_per_page: int = 1000,
) -> None:
    """Encode `docs(doc_id, text)`, append `end_id` to each, and write the files.

    Texts are dealt by ranges of doc_id before they are encoded, so ids aren't shuffled. Rows that share an id are dealt
    by a hash of their text as well. A null text counts as empty, repeated rows are all written.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(tokenizer, True), end_id.to_bytes(4, "little")
        shard, start = TaskContext.get().partitionId(), 0
        for batch in text_batches(batches, ENCODE_BYTES):
            found = [x + end for x in encoder.encode(batch.column("text"))]
            sizes = np.array([len(x) // 4 for x in found], dtype=np.int64)
            ends = np.cumsum(sizes)
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), ids)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(np.full(len(sizes), shard), pa.int32()),
                       pa.array(start + ends - sizes), pa.array(sizes), lists]
            yield pa.RecordBatch.from_arrays(columns, schema=ARROW)
            start += int(ends[-1]) if len(ends) else 0

    tie = F.xxhash64("text")
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    (
        dealt.mapInArrow(gives_back(encode), SCHEMA)
        .write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.row.count.limit", str(rows_per_page))
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the files: doc_id, shard, start_in_shard, n_tokens, ids."""
    return spark.read.schema(SCHEMA).parquet(path)


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """Per shard the ids before it, `shard_start`. Reads the counts only; one row per file is ordered in one task."""
    sums = read_tokens(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per written document: doc_id, start, n_tokens and the unsigned crc32 of its ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ids, bounds = lists.values.to_numpy().astype("<u4", copy=False), lists.offsets.to_numpy()
            view = memoryview(np.ascontiguousarray(ids)).cast("B") if len(ids) else b""
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield batch.drop_columns(["ids"]).append_column("ids_crc32", pa.array(crc, pa.int64()))

    found = read_tokens(spark, path).mapInArrow(
        digest, "doc_id long, shard int, start_in_shard long, n_tokens long, ids_crc32 long"
    )
    return found.join(token_starts(spark, path), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )
