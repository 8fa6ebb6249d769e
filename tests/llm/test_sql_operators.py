"""Registered queries with a SQL form on odd rows: nulls in any column, empty and long texts, ties, repeated rows, clashing
columns, empty tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tradewind.llm import linededup, merkle, ranking
from tradewind.llm.queries import ORACLES, QUERIES

ITEMS = [(1, "same no HERE 日本語 é"), (2, ""), (3, None), (None, "ab ab c d 12.5"), (4, "one two ONE"), (4, "one two ONE")]


def folder_of(tmp_path_factory, docs, items):
    folder = str(tmp_path_factory.mktemp("odd"))
    docs.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def odd(spark, docs, rows, tmp_path_factory):
    lines = ["Held by all", " held by ALL\t", "\xa0held by all", "É one", "é one", "", " ", "x"]
    more = [(3000 + i, "\n".join([*lines[i % 3 : i % 8], f"own {i % 5}", lines[i % 7]]), None, None, i) for i in range(40)]
    extra = spark.createDataFrame(more + more[:9], "doc_id long, text string, lang string, source string, n_chars long")
    terms = sorted({w for r in rows[:30] for w in (r[1] or "").split()})
    items = ITEMS + [(100 + i, " ".join(terms[i : i + 9])) for i in range(0, 300, 7)]
    return folder_of(tmp_path_factory, docs.unionByName(extra, allowMissingColumns=True), spark.createDataFrame(items, "item_id long, text string"))


@pytest.fixture(scope="module")
def nothing(spark, empty, tmp_path_factory):
    return folder_of(tmp_path_factory, empty, spark.createDataFrame(ITEMS, "item_id long, text string"))


def compare(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    expected = db.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, folder).select(*columns).collect()
    want = expected.fetchall()
    return Counter(map(tuple, found)), Counter(want)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_odd_rows(spark, odd, name):
    found, want = compare(spark, odd, name)
    assert want and found == want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_documents(spark, nothing, name):
    found, want = compare(spark, nothing, name)
    assert not found and not want


def test_no_items(spark, odd, docs):
    assert ranking.ranked(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_many_shards_bundles_and_owners_find_the_same(spark, docs, rows):
    words = sorted({w for r in rows[:40] for w in (r[1] or "").split()})
    items = spark.createDataFrame([(i, " ".join(words[i : i + 4])) for i in range(300)], "item_id long, text string")
    once = ranking.ranked(docs, items, k=5, owners=1)
    assert items.count() > ranking.BUNDLE
    again = ranking.ranked(docs.repartition(5), items, k=5, owners=3, shard_bytes=500)
    columns = ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, once.select(columns).collect())) == Counter(map(tuple, again.select(columns).collect()))


def test_runs_are_levelled_and_merged_without_a_shuffle(spark, docs):
    runs = linededup.LineRuns(spark, settled=10**9, buckets=4)
    expected = Counter()
    for i in range(7):
        part = linededup.line_counts(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(7)) == i))
        expected.update({(r.h1, r.h2): r.docs for r in part.collect()})
        runs.add(part)
        assert [bool(x) for x in runs.levels] == [bool((i + 1) >> n & 1) for n in range(len(runs.levels))]
    one, other = runs.runs()[:2]
    plan = spark.table(one).join(spark.table(other).hint("merge"), linededup.HASH, "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert Counter({(r.h1, r.h2): r.docs for r in runs.counts().collect()}) == expected
    runs.forget()
    assert not spark.catalog.listTables(pattern="line_run_*")


def test_settled_hashes_are_counted_no_further(spark):
    rows = spark.createDataFrame([(i, "always\n" + f"once {i}") for i in range(60)], "doc_id long, text string")
    runs = linededup.LineRuns(spark, settled=10, buckets=2)
    for i in range(4):
        runs.add(linededup.line_counts(rows.where(F.col("doc_id") % 4 == i)))
    assert runs.counts().agg(F.max("docs")).first()[0] == 15
    runs.forget()


def test_kept_text_and_columns(spark, docs, rows):
    found = linededup.without_frequent_lines(docs, least=2)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert Counter(found.select("doc_id", "lang", "source", "size").collect()) == Counter(docs.select("doc_id", "lang", "source", "size").collect())
    clash = linededup.without_frequent_lines(docs.withColumn("n_lines", F.lit("old")), least=2)
    assert dict(clash.dtypes)["n_lines"] == "bigint" and clash.count() == len(rows)


def test_line_dedup_runs_no_python(spark, odd):
    df = QUERIES["op12_line_dedup"](spark, odd)
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "MapInArrow", "MapInPandas", "InArrow", "ExternalRDD"))


def test_proofs_of_some_leaves(spark, docs):
    """The descent finds the leaves asked for, and each proof leads to the root."""
    trees = merkle.manifest(merkle.written(merkle.leaf_table(docs), "leaves"))
    some = trees.leaves.where("rank % 5 = 3")
    found = merkle.proofs(trees, some)
    assert found.count() == some.count() > 0
    wrong = (F.col("found") != F.col("leaf")) | (merkle.fold(F.col("leaf"), F.col("path")) != trees.root)
    assert found.where(wrong).count() == 0
    stored = trees.lower.records[0]
    assert stored.where(merkle.digest_of(F.col("children")) != F.col("digest")).count() == 0


def test_one_document(spark, docs):
    (row,) = merkle.prove_all(docs.where("doc_id = 2000").limit(1)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.path == [] and row.verified
