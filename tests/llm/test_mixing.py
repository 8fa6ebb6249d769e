import re
from collections import Counter, defaultdict

import pytest

from tradewind.llm import mixing
from tradewind.llm.common import WORD

WEIGHTS = [3, 1, 2]


def level_targets(sizes, share=1.5, most=2.0):
    """By cutting and sharing again, until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        goal = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if goal[s] >= most * sizes[s]]
        if not over:
            return full | goal
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


def test_targets_sizes_and_words_taken(docs, rows):
    placed, parts = mixing.mix(docs, WEIGHTS, block_words=16)
    found = mixing.words_taken(placed, parts).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(WORD, r[1] or ""))
    goal = level_targets(sizes)
    assert Counter((r.doc_id, r.source, r["size"]) for r in found) == Counter((r[0], r[3], len(re.findall(WORD, r[1] or ""))) for r in rows)
    for source, size in sizes.items():
        own = [r for r in found if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert all(r.target == pytest.approx(goal[source]) for r in own)
        assert sum(r.taken for r in own) == pytest.approx(goal[source], abs=2 * 16)
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    again = mixing.words_taken(*mixing.mix(docs.repartition(7), WEIGHTS, block_words=16)).collect()
    assert Counter(found) == Counter(again)


def test_mixed_documents_hold_the_words_taken(docs, rows):
    taken = Counter()
    for r in mixing.words_taken(*mixing.mix(docs, WEIGHTS, block_words=16)).collect():
        taken[r.doc_id] += r.taken
    mixed = mixing.mixed_documents(docs, WEIGHTS, block_words=16)
    assert mixed.columns == docs.columns
    assert mixed.select(*docs.columns[5:]).distinct().collect() == docs.select(*docs.columns[5:]).distinct().collect()
    words = Counter()
    texts = {}
    for r in rows:
        texts.setdefault(r[0], set()).add(" ".join(re.findall(WORD, r[1] or "")))
    for r in mixed.collect():
        own = re.findall(WORD, r.text)
        words[r.doc_id] += len(own)
        assert r.n_chars == len(r.text)
    assert +words == +taken


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 5, 12, 97, 1000):
        found = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit("s")).alias("x")).collect()
        assert sorted(r.x for r in found) == list(range(n))


def test_empty_table(empty):
    assert mixing.words_taken(*mixing.mix(empty, WEIGHTS)).count() == 0
    assert mixing.mixed_documents(empty, WEIGHTS).count() == 0


def test_no_python_runs_on_executors(docs):
    plan = mixing.mixed_documents(docs, WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_places_undo_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 5, 12, 97, 1000):
        count, key = F.lit(n).cast("long"), (F.lit("s"), F.lit(1).cast("long"))
        moved = spark.range(n).select("id", mixing._permuted(F.col("id"), count, *key).alias("x"))
        assert moved.where(mixing._place(F.col("x"), count, *key) != F.col("id")).count() == 0


@pytest.mark.parametrize("most", [1.3, 2.0])
def test_small_sources_reach_their_targets(spark, most):
    """Beside a hot source, sources of less than a block and of few blocks are taken to their limit, word by word."""
    sizes = {"hot": 30_000} | {f"s{n}": n for n in (1, 5, 10, 64, 127, 128, 129, 130, 400, 900, 5_000)}
    rows = [(i, " ".join(["w"] * n), "en", s, 2 * n - 1) for i, (s, n) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.words_taken(*mixing.mix(docs, [9, 1, 2], most=most, share=1.2)).collect()
    goal = {r.source: r.target for r in found}
    assert sum(goal[s] == most * n for s, n in sizes.items()) >= 5
    for r in found:
        assert abs(r.taken - r.target) <= 0.5


def test_many_sources(spark):
    """Far more sources than cells, beside a hot one; each is within a word of its target, whatever the layout."""
    rows = [(i, " ".join(["w"] * (1 + i % 7)), f"site{i}.example" if i else "hot") for i in range(3_000)]
    rows[0] = (0, " ".join(["w"] * 12_000), "hot")
    rows += [(3_000, "two words", None), (3_001, None, "no words"), (3_002, "a", "site\U0001F600"), (3_003, "b", "site\uFFFD")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    goal = level_targets({s: len((t or "").split()) for _, t, s in rows})
    found = mixing.words_taken(*mixing.mix(docs, WEIGHTS, block_words=4)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.target == pytest.approx(goal[r.source]) and abs(r.taken - r.target) <= 0.5
    assert Counter(found) == Counter(mixing.words_taken(*mixing.mix(docs.coalesce(1), WEIGHTS, block_words=4)).collect())


@pytest.mark.parametrize("n", [0, 1, 500])
def test_ordered_totals(spark, n):
    from pyspark.sql import functions as F

    from tradewind.llm.common import ordered_totals

    rows = [(i * 37 % 101, i, i * 0.5) for i in range(n)]
    frame = spark.createDataFrame(rows, "a long, b long, x double").repartition(6)
    found = ordered_totals(frame, ["a", "b"], {"rows": F.lit(1), "sum": F.col("x")}).collect()
    assert {(r.a, r.b): (r.rows, r["sum"]) for r in found} == {(a, b): (i, sum(x for _, _, x in sorted(rows)[:i])) for i, (a, b, _) in enumerate(sorted(rows))}
