"""One query per operator over a folder of tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import counting, langid, linededup, merkle, mixing, packing, quality, ranking, repeats, rules, simhash, tokenfiles, topk
from .common import crc_of_id, reach_workers, shared_folder, written
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def tokenizer(name: str) -> str:
    """Where a public vocabulary file lies."""
    from public_tokenizers import path

    return path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    placed, parts = mixing.mix(documents(spark, folder), weights=[3, 1, 2], share=1.5, most=2.0)
    return mixing.words_taken(placed, parts)


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder), tokenizer("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 50; all rows are searched, the query's own too."""
    reach_workers(spark)
    codes = written(topk.sign_codes(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id", "embedding"), "sign-codes")
    return topk.nearest(codes, codes.where("id % 50 = 0"), k=10)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = counting.count_tokens(documents(spark, folder), tokenizer("piece_bpe_32k.model"), limit=4096)
    return counts.drop("prefix_ends", "tokens_at")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judge(documents(spark, folder))
    return found.drop("covered_words", "longest_repeat")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = crc_of_id() % 3 == 1
    found = langid.predict(docs, langid.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def quality_model(spark: SparkSession, measured: DataFrame, folder: str) -> quality.Model | None:
    """From the labels of rows that aren't held out."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(crc_of_id() % 4 != 2)
    return quality.fit(measured, labels.select("doc_id", F.col("quality").alias("label")))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    measured = written(quality.measure(documents(spark, folder)), "statistics")
    found = quality.score(measured, quality_model(spark, measured, folder))
    held_out, predicted = crc_of_id() % 4 == 2, (F.col("score") >= 0.7).cast("int")
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op8_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder), shingle=4, bits=4)


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "tokens")
    tokenfiles.write_tokens(documents(spark, folder), path, tokenizer("word_bpe_49k.json"), end_id=1)
    return tokenfiles.token_digests(spark, path)


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removals(documents(spark, folder))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return ranking.ranked(documents(spark, folder), items, k=20).drop("item")


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = linededup.without_frequent_lines(documents(spark, folder).select("doc_id", "text"), least=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.prove_all(documents(spark, folder)).drop("path")


QUERIES = {f.__name__: f for f in (op1_source_mix, op2_best_fit_packing, op3_topk_search, op4_token_counts, op5_quality_rules, op6_language_id, op7_quality_classifier, op8_simhash_dedup, op9_token_files, op10_suffix_dedup, op11_ranked_search, op12_line_dedup, op13_merkle_manifest)}
