"""A corpus pipeline: documents of good quality, without near-duplicates and long repeats, mixed and packed.

Each stage gets what its predecessor kept, written as Parquet and read again, and returns it with the columns of
`documents`; the last returns the packed pieces. A text may be in several rows after mixing, one for each pass
over its source that takes words of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import mixing, packing, quality, queries, repeats, simhash
from tradewind.llm.common import reach_workers, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more."""
    reach_workers(spark)
    measured = written(quality.measure(docs), "statistics")
    return quality.accepted(docs, queries.quality_model(spark, measured, sf_dir), least=0.7)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates."""
    reach_workers(spark)
    return simhash.without_near_duplicates(docs, shingle=4, bits=4)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur more than once."""
    reach_workers(spark)
    return repeats.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a mix by source weights takes, half as large again as its input."""
    return mixing.mixed_documents(docs, weights=[3, 1, 2], share=1.5, most=2.0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their places in sequences of that length."""
    reach_workers(spark)
    return packing.packed(docs, queries.tokenizer("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", best_fit_packing),
]

# The stages' fingerprints, trained model and tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table `documents` on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
