"""Mixing sources to target weights, in blocks of words, with DataFrame functions only.

The words of a source's documents, one after another, are cut into blocks of a fixed number of words. The mix is a row
of slots, cut into output shards; each slot draws a source, so a shard's counts per source are multinomial. A source's
k-th draw takes its block pi(k), where pi is a pseudorandom permutation of the block numbers, a new one for each pass
over the source; blocks and draws are joined by block number. A source's draws end with the word that reaches its target.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, ordered_totals, running_totals, set_aside, written

BLOCK_WORDS = 128
SLOTS_PER_SHARD = 1024
SEED = 20_011
# Cells, at least, into which the slots' range is cut to find the source of a draw by an equi-join; as many as sources, if
# these are more.
CELLS = 1024
# Steps allowed to walk back into a source's range of blocks. Up to 4,096 blocks there are fewer numbers outside than
# that; for more blocks a walk of this length has a chance below 64 ** -64.
WALK = 64


def word_count(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str = "source") -> Column:
    """The source as a non-null text, null last: sources by code point come before the key of null."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Per source its size in words and target: `share` times all words, dealt by weight, but at most `most` times the
    source's own words; what is cut off there goes to the others by weight.

    Sources take the weights in turn, by code point, null last. The level, words per weight, at which all is dealt is
    the largest found by taking sources with the smallest limits as full, one after another. Sources are ordered by
    ranges over all tasks, so there may be very many.
    """
    by_source = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    turn = F.pmod("turn", F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    limits = ordered_totals(by_source, ["source_key"], {"turn": F.lit(1)}).withColumn("weight", weight).drop("turn")
    limits = limits.withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("fills", F.col("limit") / F.col("weight"))
    limits = ordered_totals(limits, ["fills", "source_key"], {"full": F.col("limit"), "spent": F.col("weight")})
    words, every = limits.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    left = F.lit(float(words)) * F.lit(float(share)) - F.col("full")
    level = limits.agg(F.coalesce(F.max(left / (F.lit(every) - F.col("spent"))), F.lit(0.0))).first()[0]
    return limits.select("source_key", "source_size", F.least("limit", F.lit(level) * F.col("weight")).alias("target"))


def _quotas(goals: DataFrame, block_words: int) -> DataFrame:
    """Per source: blocks, draws, words of the last draw, and the source's part [low, high) of all draws.

    The draws are whole passes over the source, and one pass more until the words left are used up. A source's last block
    may be shorter than the others, so it counts where that block comes in this pass.
    """
    whole = F.lit(block_words)
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    q = goals.withColumns({"blocks": blocks, "words": F.round("target").cast("long")})
    q = q.withColumn("rest", F.pmod("words", F.greatest("source_size", F.lit(1))))
    q = q.withColumn("passes", ((F.col("words") - F.col("rest")) / F.greatest("source_size", F.lit(1))).cast("long"))
    place = _place(F.col("blocks") - 1, F.greatest("blocks", F.lit(1)), F.col("source_key"), F.col("passes"))
    q = q.withColumns({"place": place, "missing": F.col("blocks") * block_words - F.col("source_size")})

    def held(draws: Column) -> Column:
        """Words of the last pass's first `draws` blocks."""
        return draws * whole - F.when(F.col("place") < draws, F.col("missing")).otherwise(0)

    few = F.ceil(F.col("rest") / block_words).cast("long")
    q = q.withColumn("more", few + (held(few) < F.col("rest")).cast("long"))
    last = F.when(F.col("rest") > 0, F.col("rest") - held(F.col("more") - 1)).otherwise(whole)
    q = q.withColumns({"draws": F.col("passes") * F.col("blocks") + F.col("more"), "last_words": last})
    q = q.drop("words", "rest", "passes", "place", "missing", "more")
    return running_totals(q, [], ["source_key"], {"low": F.col("draws")}).withColumn("high", F.col("low") + F.col("draws"))


def _grid(n: Column) -> tuple[Column, Column]:
    """Rows and columns of a grid that holds n numbers and fewer than a row more."""
    rows = F.greatest(F.floor(F.sqrt(n)).cast("long"), F.lit(1).cast("long"))
    return rows, F.ceil(n / rows).cast("long")


def _walked(start: Column, n: Column, step: Callable[[Column], Column]) -> Column:
    """The first number below n of step(start), step(step(start)), ..."""
    walk = F.sequence(F.lit(1), F.lit(WALK))
    # Nearly all numbers lie below n after one step, so the walk is seldom taken.
    first = step(start)
    return F.when(first < n, first).otherwise(F.aggregate(walk, first, lambda x, _: F.when(x < n, x).otherwise(step(x))))


def _permuted(k: Column, n: Column, *key: Column, rounds: int = 4) -> Column:
    """pi(k) for k in [0, n): a Feistel network on a rows-by-columns grid that holds n numbers and fewer than a row
    more, walked on until the number lies below n."""
    rows, columns = _grid(n)

    def step(x: Column) -> Column:
        a, b = (x / columns).cast("long"), F.pmod(x, columns)
        for i in range(rounds):
            if i % 2:
                a = F.pmod(a + F.pmod(F.xxhash64(F.lit(SEED + i), *key, b), rows), rows)
            else:
                b = F.pmod(b + F.pmod(F.xxhash64(F.lit(SEED + i), *key, a), columns), columns)
        return a * columns + b

    return _walked(k, n, step)


def _place(block: Column, n: Column, *key: Column, rounds: int = 4) -> Column:
    """The k in [0, n) with pi(k) = block: the network's rounds undone from the last on, and the same walk."""
    rows, columns = _grid(n)

    def step(x: Column) -> Column:
        a, b = (x / columns).cast("long"), F.pmod(x, columns)
        for i in reversed(range(rounds)):
            if i % 2:
                a = F.pmod(a - F.pmod(F.xxhash64(F.lit(SEED + i), *key, b), rows), rows)
            else:
                b = F.pmod(b - F.pmod(F.xxhash64(F.lit(SEED + i), *key, a), columns), columns)
        return a * columns + b

    return _walked(block, n, step)


def draw(quotas: DataFrame, slots: int, block_words: int) -> DataFrame:
    """Draws: shard, source_key, block, the pass over the source, and how many of the block's first words it takes.

    A source that is drawn more often than its quota gives its last draws to the sources drawn too rarely, in their
    shards, so each source is drawn as often as its quota says. A source's draws are numbered bucket by bucket of shards,
    so no task goes through all shards.
    """
    spark = quotas.sparkSession
    slot = spark.range(slots).select(
        (F.col("id") / SLOTS_PER_SHARD).cast("long").alias("shard"),
        F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(max(slots, 1))).alias("drawn"),
    )
    width = max(1, -(-slots // max(CELLS, quotas.count())))
    first_cell, last_cell = (F.col("low") / width).cast("long"), ((F.col("high") - 1) / width).cast("long")
    cells = quotas.where("draws > 0").select("source_key", "low", "high", F.explode(F.sequence(first_cell, last_cell)).alias("cell"))
    found = slot.withColumn("cell", (F.col("drawn") / width).cast("long")).join(cells, "cell").where("low <= drawn AND drawn < high")
    counts = written(found.groupBy("shard", "source_key").agg(F.count("*").alias("n")), "draws")
    numbered = running_totals(counts, ["source_key"], ["shard"], {"begin": F.col("n")})
    # Draws beyond the quota, numbered over all shards, and draws that are missing, numbered over all sources.
    kept = F.greatest(F.least(F.col("n"), F.col("draws") - F.col("begin")), F.lit(0))
    own = numbered.join(quotas.select("source_key", "draws"), "source_key").withColumn("kept", kept)
    taken = own.where("kept > 0").select(
        "shard", "source_key", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("kept") - 1)).alias("k")
    )
    free = own.groupBy("shard").agg(F.sum(F.col("n") - F.col("kept")).alias("free")).where("free > 0")
    free = running_totals(free, [], ["shard"], {"begin": F.col("free")})
    free = free.select("shard", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("free") - 1)).alias("spare"))
    had = counts.groupBy("source_key").agg(F.sum("n").alias("had"))
    short = quotas.join(had, "source_key", "left").withColumn("had", F.coalesce("had", F.lit(0)))
    short = short.withColumn("lack", F.greatest(F.col("draws") - F.col("had"), F.lit(0))).where("lack > 0")
    short = running_totals(short.select("source_key", "had", "lack"), [], ["source_key"], {"first": F.col("lack")}).select(
        "source_key", "had", "first", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("lack") - 1)).alias("spare")
    )
    given = free.join(short, "spare").select("shard", "source_key", (F.col("had") + F.col("spare") - F.col("first")).alias("k"))
    every = taken.unionByName(given).join(quotas.select("source_key", "blocks", "draws", "last_words"), "source_key")
    turn = (F.col("k") / F.col("blocks")).cast("long")
    return every.select(
        "shard",
        "source_key",
        _permuted(F.pmod("k", "blocks"), F.col("blocks"), F.col("source_key"), turn).alias("block"),
        turn.alias("turn"),
        F.when(F.col("k") == F.col("draws") - 1, F.col("last_words")).otherwise(F.lit(block_words)).alias("first_words"),
    )


def mix(
    docs: DataFrame,
    weights: list[int],
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The mix of `docs(doc_id, text, source)`: its documents and its parts.

    Documents: doc_id, source, text_hash, size, source_key, low (the document's first word in its source), rank,
    source_size, target. Parts, one row per draw and document that it touches: source_key, rank, doc_id, shard, turn,
    from_word and to_word in the document.

    A null text has no words; a null source is a source of its own; a null id is an id. Repeated rows are documents of
    their own and may swap places. A source without words has target 0. `most` times a document's words are taken at
    most. The same rows give the same mix.
    """
    columns = ["doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count().alias("size"), source_key().alias("source_key")]
    sizes = written(docs.select(*columns), "sizes")
    goals = written(targets(sizes, weights, share, most), "targets")
    quotas = written(_quotas(goals, block_words), "quotas")
    slots = quotas.agg(F.coalesce(F.sum("draws"), F.lit(0))).first()[0]
    order = ["doc_id", "size", "text_hash"]
    ranked = running_totals(sizes, ["source_key"], order, {"low": F.col("size"), "rank": F.lit(1)})
    placed = written(ranked.join(goals, "source_key"), "placed")
    draws = draw(quotas, slots, block_words)
    first, last = (F.col("low") / block_words).cast("long"), ((F.col("low") + F.col("size") - 1) / block_words).cast("long")
    touched = placed.where("size > 0").select("source_key", "rank", "doc_id", "low", "size", F.explode(F.sequence(first, last)).alias("block"))
    start = F.col("block") * block_words
    parts = touched.join(draws, ["source_key", "block"]).select(
        "source_key", "rank", "doc_id", "shard", "turn",
        (F.greatest(start, F.col("low")) - F.col("low")).alias("from_word"),
        (F.least(start + F.col("first_words"), F.col("low") + F.col("size")) - F.col("low")).alias("to_word"),
    ).where("from_word < to_word")
    return placed, parts


def words_taken(placed: DataFrame, parts: DataFrame) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target and the words that the mix takes of it."""
    taken = parts.groupBy("source_key", "rank").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return placed.join(taken, ["source_key", "rank"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: list[int], **options: float) -> DataFrame:
    """What the mix takes, as documents with the columns of `docs`: a row for each document and pass over its source
    that takes words of it. A text taken whole is left as it is; else its taken words are joined by spaces, in order.
    Other columns may have any names.
    """
    names, docs = docs.columns, set_aside(docs, ("doc_id", "text", "source", "n_chars"))
    placed, parts = mix(docs, weights, **options)
    # Rows that agree in id, source and text are alike; a number tells them apart on both sides of the join.
    alike = ["_id", "_source", "_hash"]
    copy = F.row_number().over(Window.partitionBy(*alike).orderBy("_rank"))
    placing = {"_id": F.col("doc_id"), "_source": F.col("source_key"), "_hash": F.col("text_hash"), "_rank": F.col("rank")}
    ranked = placed.select(*(c.alias(n) for n, c in placing.items()), F.col("size").alias("_size")).withColumn("_copy", copy)
    spans = F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("_spans")
    taken = parts.groupBy(F.col("source_key").alias("_source"), F.col("rank").alias("_rank"), "turn").agg(spans)
    taken = ranked.join(taken, ["_source", "_rank"]).drop("_rank")
    own = {"_id": F.col("doc_id"), "_source": source_key(), "_hash": F.xxhash64("text"), "_rank": F.lit(0)}
    texts = docs.select("*", *(c.alias(f"{n}_own") for n, c in own.items()))
    numbers = F.row_number().over(Window.partitionBy(*(f"{n}_own" for n in alike)).orderBy("_rank_own"))
    texts = texts.withColumn("_copy_own", numbers)
    same = reduce(lambda a, b: a & b, (F.col(f"{n}_own").eqNullSafe(F.col(n)) for n in [*alike, "_copy"]))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.transform("_spans", lambda x: F.slice(words, (x["from_word"] + 1).cast("int"), (x["to_word"] - x["from_word"]).cast("int")))
    length = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, x: n + x["to_word"] - x["from_word"])
    text = F.when(length == F.col("_size"), F.col("text")).otherwise(F.array_join(F.flatten(cut), " "))
    found = texts.join(taken, same).withColumn("text", text)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns).toDF(*names)
