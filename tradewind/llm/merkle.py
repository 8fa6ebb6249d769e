"""Merkle trees over documents: a content-addressed store of digests and their children, and proofs by descent.

Per language the documents' digests ascend by doc_id; runs of `FANOUT` nodes get a parent, whose digest is that of theirs
in a row, until one node is left. Those of the languages are the leaves of a last tree of the same form, whose top is the
root. The store keeps for each inner digest its children's digests, once, however often it occurs.

A proof comes from the store alone: a request for a leaf begins at the root, looks up the digest it stands at, takes the
child that the next digit of the leaf's rank names, and keeps that one's siblings. Requests that share a path so far are
one row, so the descent handles a row per node and not one per leaf and level, and no digest near the root is asked for
by very many rows. At the leaf the segments are reversed.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_spread
from ..operators.ranks import positions
from .common import set_aside, shared_folder, written
from .linededup import ascii_lower

FANOUT = 8
# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# Nodes with their paths that one task writes.
NODES_PER_TASK = 20_000


class Tree(NamedTuple):
    """`records[i]`, written: tree, rank, n, digest, children of the nodes of height i + 1. `tops`, written: tree, height,
    digest. `leaves` and `trees` count these."""

    records: list[DataFrame]
    tops: DataFrame
    leaves: int
    trees: int


class Manifest(NamedTuple):
    """`leaves`: tree, rank, n, digest and what `leaf_table` had. `languages`: lang, tree. `root` is null where there is
    no document."""

    leaves: DataFrame
    languages: DataFrame
    lower: Tree
    upper: Tree
    root: str | None


def leaf_digest(fields: dict[str, Column]) -> Column:
    """SHA-256 of the fields in a row, each as its length in bytes, a colon and its value, or `-` for null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*(field(fields[name]) for name in FIELDS)), 256)


def digest_of(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def _nodes(df: DataFrame, leaves: int, trees: int, height: int, name: str) -> DataFrame:
    """A written table of at most one row per node of a height, in as many files as these need."""
    return written(df.coalesce(1 + (leaves // FANOUT**height + trees) // NODES_PER_TASK), f"{name}-{height}")


def _build(level: DataFrame, leaves: int, trees: int, most: int, name: str) -> Tree:
    """Trees over leaves (tree, rank from 0, n leaves of the tree, digest); `most` is the largest n."""
    tops, records = [level.where("n = 1").select("tree", F.lit(0).alias("height"), "digest")], []
    while most > 1:
        run = F.expr(f"rank div {FANOUT}").alias("run")
        children = F.sort_array(F.collect_list(F.struct("rank", "digest")))
        nodes = level.where("n > 1").groupBy("tree", run, "n").agg(children.alias("own"))
        above = F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")
        nodes = nodes.select("tree", F.col("run").alias("rank"), above, F.col("own.digest").alias("children"))
        level = _nodes(nodes.withColumn("digest", digest_of(F.col("children"))), leaves, trees, len(records) + 1, name)
        records.append(level)
        tops.append(level.where("n = 1").select("tree", F.lit(len(records)).alias("height"), "digest"))
        most = -(-most // FANOUT)
    return Tree(records, _nodes(reduce(DataFrame.union, tops), 0, trees, 0, f"{name}-tops"), leaves, trees)


def _descend(tree: Tree, requests: DataFrame, starts: DataFrame, name: str) -> DataFrame:
    """`requests` (tree, rank, n, other columns) with `top`, the digest where the descent begins, `found`, the leaf digest
    where it ends, and `steps`: the siblings before and after the path, from `starts` (tree, height, digest, steps) down."""
    height = len(tree.records)
    # The nodes that requests pass, by height.
    passed = {0: requests.where("n > 1").select("tree", "rank")}
    for i in range(1, height + 1):
        above = passed[i - 1].select("tree", F.expr(f"rank div {FANOUT}").alias("rank")).distinct()
        passed[i] = _nodes(above, tree.leaves, tree.trees, i, f"{name}-passed") if i < height else above
    state, starts = None, starts.withColumn("top", F.col("digest"))
    for i in range(height, 0, -1):
        entering = starts.where(F.col("height") == i).select("tree", F.lit(0).cast("long").alias("rank"), "digest", "top", "steps")
        state = entering if state is None else state.union(entering)
        record = tree.records[i - 1].select("digest", "children").dropDuplicates(["digest"])
        node = state.join(record, "digest").select("tree", F.col("rank").alias("run"), "children", "top", "steps")
        asked = requests.where("n > 1") if i == 1 else passed[i - 1]
        digit = (F.col("rank") % FANOUT).cast("int")
        step = F.struct(
            F.array_join(F.slice("children", 1, digit), "").alias("before"),
            F.array_join(F.slice("children", digit + 2, FANOUT), "").alias("after"),
        )
        child = F.get("children", digit)
        asked = asked.withColumn("run", F.expr(f"rank div {FANOUT}")).join(node, ["tree", "run"]).drop("run")
        if i == 1:
            state = asked.withColumns({"found": child, "steps": F.array_append("steps", step)}).drop("children")
        else:
            state = asked.select("tree", "rank", child.alias("digest"), "top", F.array_append("steps", step).alias("steps"))
            state = _nodes(state, tree.leaves, tree.trees, i - 1, f"{name}-at")
    alone = starts.where("height = 0").select("tree", "top", F.col("digest").alias("found"), "steps")
    lone = requests.where("n = 1").join(alone, "tree")
    return lone if state is None else state.unionByName(lone)


def leaf_table(docs: DataFrame) -> DataFrame:
    """Per document doc_id, lang, `leaf` and `tampered`, the leaf of the document with A-Z of its text made small where 3
    divides the crc32 of its doc_id, else the same. A null doc_id counts as the empty text there, whose crc32 is 0."""
    fields = {name: F.col(name) for name in FIELDS}
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    other = leaf_digest(fields | {"text": ascii_lower(F.col("text"))})
    leaf = leaf_digest(fields)
    return docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(crc % 3 == 0, other).alias("changed")).select(
        "doc_id", "lang", "leaf", F.coalesce("changed", "leaf").alias("tampered")
    )


def manifest(leaves: DataFrame) -> Manifest:
    """The trees over `leaves(doc_id, lang, leaf, ...)`, a written table.

    In a language leaves ascend by doc_id, null first, those that share it by digest; a null language is one by itself,
    before the others. An empty table has no root.
    """
    folder = shared_folder(leaves.sparkSession, "manifest")
    # Equal rows are dealt to tasks by their number in the input: which of them comes first makes no difference.
    number = leaves.withColumn("_number", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("lang", "doc_id", "leaf", "_number")]
    placed = positions(number, order, f"{folder}/leaves", "_position").drop("_number")
    held = placed.groupBy("lang").agg(F.min("_position").alias("first"), F.count(F.lit(1)).alias("n"))
    languages = positions(held, [F.col("lang").asc_nulls_first()], f"{folder}/languages", "tree")
    ranked = join_spread(placed, languages.select("lang", "tree", "n", "first"), ["lang"])
    ranked = ranked.withColumn("rank", F.col("_position") - F.col("first")).drop("_position", "first")
    sizes = languages.agg(
        F.count(F.lit(1)).alias("trees"), F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("leaves")
    ).first()
    nodes = ranked.select("tree", "rank", "n", F.col("leaf").alias("digest"))
    lower = _build(nodes, sizes.leaves, sizes.trees, sizes.most, "nodes")
    n = F.lit(sizes.trees).cast("long").alias("n")
    tops = lower.tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), n, "digest")
    upper = _build(tops, sizes.trees, 1, sizes.trees, "top-nodes")
    root = upper.tops.first()
    return Manifest(ranked, languages, lower, upper, root and root["digest"])


def proofs(trees: Manifest, requests: DataFrame) -> DataFrame:
    """`requests`, rows of `trees.leaves`, with `subroot` and `path`: the siblings from the leaf up, as digests in a row
    `before` and `after` the path's own node, both empty where that has none."""
    none = F.array().cast("array<struct<before:string,after:string>>")
    wanted = requests.select("tree").distinct().join(trees.lower.tops, "tree")
    zero, n = F.lit(0).cast("long").alias("tree"), F.lit(trees.upper.leaves).cast("long").alias("n")
    wanted = _nodes(wanted.select(zero, F.col("tree").alias("rank"), n, "height"), 0, trees.upper.leaves, 0, "top-requests")
    at_root = trees.upper.tops.withColumn("steps", none)
    found = _descend(trees.upper, wanted, at_root, "top")
    starts = found.select(F.col("rank").alias("tree"), "height", F.col("found").alias("digest"), "steps")
    starts = _nodes(starts, 0, trees.upper.leaves, 0, "starts")
    paths = _descend(trees.lower, requests, starts, "leaf").withColumnRenamed("top", "subroot")
    return paths.withColumn("path", F.reverse("steps")).drop("steps")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path's siblings lead to."""
    return F.aggregate(path, leaf, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests in a row, from the leaf up."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def prove_all(docs: DataFrame) -> DataFrame:
    """For every document of `docs` (`FIELDS`) its leaf, the digests above it, its path and whether its tampered form is
    found out: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, path.

    Nulls in any field are `-`, so a null text and an empty one differ. Repeated rows have a leaf each. A document alone
    in a language alone has an empty path. Other columns are ignored; an empty table gives an empty one.
    """
    own = set_aside(docs, FIELDS)
    trees = manifest(written(leaf_table(own), "leaves"))
    found = proofs(trees, trees.leaves).withColumn("root", F.lit(trees.root).cast("string"))
    found = found.withColumn("folded_root", fold(F.col("tampered"), F.col("path")))
    proof = F.sha2(siblings(F.col("path")), 256)
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), "path",
    )
