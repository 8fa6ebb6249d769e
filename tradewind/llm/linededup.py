"""Removal of lines that many documents hold, by levelled sorted runs of line hashes.

Documents come in batches. A batch becomes a run: a table of the 128-bit hashes of its lines and the number of documents
that hold each, bucketed and sorted by hash. Hashes that the runs already know to be frequent are taken out of a new
batch by a merge anti-join first, bucket against bucket, since more counts can't change what happens to them. Two runs of
a level are merged into one of the next, also bucket by bucket. So there is a run per level at most, each hash is
rewritten once per level, and neither a new batch nor a merge shuffles the runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import set_aside, shared_folder, written

# What is stripped from both ends of a line, and the letters made small.
SPACES = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HASH = ["h1", "h2"]
# Documents that agree in both hashes agree in doc_id and text, so their lines share a verdict.
DOCUMENT = ["d1", "d2"]
# Lines held by more than one in this many of all lines count as hot; there are fewer of them than that.
HOT_SHARE = 1000
# Parts that the rows of a hot line are dealt to.
HOT_PARTS = 64


def ascii_lower(text: Column) -> Column:
    """A-Z made small, other letters left as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, CAPITALS, CAPITALS.lower()))


def lines(text: Column) -> Column:
    """The lines of a text; one empty line for null or nothing."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def keys_of(text: Column) -> Column:
    """Each line's key: stripped, A-Z made small."""
    return F.transform(lines(ascii_lower(text)), lambda line: F.btrim(line, F.lit(SPACES)))


def line_counts(docs: DataFrame, *groups: Column) -> DataFrame:
    """Per line key of at least one character the number of documents that hold it: its hash, `docs` and the `groups`.

    A document counts a key once. Counts are combined in the task before they are shuffled, so a line of every
    document is one row per task.
    """
    key = docs.select(*groups, F.explode(F.array_distinct(keys_of(F.col("text")))).alias("key")).where("key != ''")
    held = key.drop("key").columns
    return key.select(*held, *hashes(F.col("key"))).groupBy(*held, *HASH).agg(F.count(F.lit(1)).alias("docs"))


class LineRuns:
    """Levelled runs of line hashes with counts of documents; a hash counted `settled` times is counted no further.

    Runs are tables of the session's catalog over files in the shared folder; `forget` takes them out of the catalog.
    """

    def __init__(self, spark: SparkSession, settled: int, buckets: int | None = None):
        self.spark, self.settled = spark, settled
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = shared_folder(spark, "line-runs")
        self.levels: list[str | None] = []

    def runs(self) -> list[str]:
        return [name for name in self.levels if name]

    def _write(self, counts: DataFrame) -> str:
        """A run. Its rows are in one task per bucket already."""
        name = f"line_run_{uuid.uuid4().hex}"
        writer = counts.select(*HASH, "docs").write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
        writer.option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        return name

    def _merged(self, one: str, other: str) -> str:
        """Two runs as one, by a merge join of their buckets."""
        a, b = self.spark.table(one), self.spark.table(other).withColumnRenamed("docs", "more")
        docs = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
        name = self._write(a.join(b.hint("merge"), HASH, "full").withColumn("docs", docs))
        self.forget([one, other])
        return name

    def add(self, counts: DataFrame) -> None:
        """One batch of `line_counts` becomes a run, without the hashes that are settled already; two runs of a level
        become one of the next."""
        counts = counts.repartition(self.buckets, *HASH)
        for name in self.runs():
            settled = self.spark.table(name).where(F.col("docs") >= self.settled).select(*HASH)
            counts = counts.join(settled.hint("merge"), HASH, "left_anti")
        run, level = self._write(counts), 0
        while level < len(self.levels) and self.levels[level]:
            run, self.levels[level], level = self._merged(self.levels[level], run), None, level + 1
        self.levels[level : level + 1] = [run]

    def counts(self) -> DataFrame:
        """All hashes with `docs`, exact below `settled` and at least that from there on. Merges what runs are left."""
        run = None
        for name in self.runs():
            run = self._merged(run, name) if run else name
        self.levels = [None] * (len(self.levels) - 1) + [run]
        return self.spark.table(run)

    def forget(self, names: list[str] | None = None) -> None:
        for name in self.runs() if names is None else names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def frequent_lines(docs: DataFrame, least: int, batches: int = 4) -> DataFrame:
    """Hashes of the line keys that at least `least` documents hold, with `docs`, at least that; a written table."""
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    path = shared_folder(docs.sparkSession, "line-batches")
    counted = line_counts(docs, batch)
    counted.write.partitionBy("batch").parquet(path)
    arrived = docs.sparkSession.read.schema(counted.schema).parquet(path)
    runs = LineRuns(docs.sparkSession, least)
    for i in range(batches):
        runs.add(arrived.where(F.col("batch") == i).drop("batch"))
    found = written(runs.counts().where(F.col("docs") >= least), "frequent-lines")
    runs.forget()
    return found


def _dropped(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per document with frequent lines: its key and the ascending numbers of these lines, from 0.

    Lines with more than a thousandth of the counts of all frequent ones are fewer than `HOT_SHARE`, so they are
    broadcast, and their rows are dealt to parts before they meet the frequent hashes; a line of a third of all documents
    isn't one task. Counts of settled lines are too small by at most the number of batches, which is near enough here.
    """
    total = frequent.agg(F.sum("docs").alias("total")).scalar()
    hot = frequent.where(F.col("docs") * HOT_SHARE > total).select(*HASH, F.lit(True).alias("hot"))
    every = frequent.join(F.broadcast(hot), HASH, "left")
    parts = F.sequence(F.lit(0), F.when(F.col("hot"), HOT_PARTS - 1).otherwise(0))
    every = every.select(*HASH, F.explode(parts).alias("part"))
    line = docs.select(*DOCUMENT, F.posexplode(keys_of(F.col("text"))).alias("at", "key")).where("key != ''")
    line = line.select(*DOCUMENT, "at", *hashes(F.col("key"))).join(F.broadcast(hot), HASH, "left")
    part = F.when(F.col("hot"), F.pmod(F.xxhash64(*DOCUMENT, "at"), F.lit(HOT_PARTS))).otherwise(0).cast("int")
    met = line.withColumn("part", part).join(every, [*HASH, "part"])
    return met.groupBy(*DOCUMENT).agg(F.array_sort(F.collect_set("at")).alias("at"))


def without_frequent_lines(docs: DataFrame, least: int = 10, batches: int = 4) -> DataFrame:
    """`docs(doc_id, text)` with all lines taken out whose key at least `least` documents hold; adds `n_lines`, before
    that, and `n_dropped`.

    A line's key is the line without white space at its ends, A-Z made small; empty keys never count. Rows count as
    documents each, also those that share an id or are equal. A null or empty text is one empty line and stays empty.
    Other columns are kept as they are, but for such with the names of the two counts, which are replaced. An empty
    table gives an empty one. Lines are told apart by 128-bit hashes.
    """
    names = docs.columns
    own = set_aside(docs, ("doc_id", "text"))
    keyed = own.withColumns({"d1": F.xxhash64("doc_id", "text"), "d2": F.xxhash64(F.lit(1), "doc_id", "text")})
    frequent = frequent_lines(own.select("doc_id", "text"), least, batches)
    at = _dropped(keyed.select(*DOCUMENT, "text"), frequent)
    # One flag per line up to the last dropped one.
    last = F.concat(F.array(F.lit(-1)), F.slice("at", 1, F.size("at") - 1))
    flags = F.zip_with(last, F.col("at"), lambda a, b: F.concat(F.array_repeat(F.lit(False), b - a - 1), F.array(F.lit(True))))
    gone = at.select(*DOCUMENT, F.flatten(flags).alias("_gone"), F.size("at").cast("long").alias("_n"))
    both = keyed.join(gone, DOCUMENT, "left")
    kept = F.filter(lines(F.col("text")), lambda line, i: ~F.coalesce(F.get(F.col("_gone"), i), F.lit(False)))
    counts = {"n_lines": F.size(lines(F.col("text"))).cast("long"), "n_dropped": F.coalesce(F.col("_n"), F.lit(0))}
    found = both.withColumns({"text": F.array_join(kept, "\n"), **counts}).select(*own.columns, *counts)
    old = [c for c, name in zip(own.columns, names, strict=True) if name in counts]
    return found.drop(*old).toDF(*(c for c in names if c not in counts), *counts)
