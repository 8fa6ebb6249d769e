from collections import Counter

import numpy as np
import pytest
from plans import executed_plan

from tradewind.llm import topk


def brute_force(rows, queries, k):
    expected = Counter()
    for q, code in queries:
        near = sorted(((code ^ c) % 2**64).bit_count() * 10**6 + i for i, c in rows)[:k]
        expected.update((q, x % 10**6, x // 10**6, r + 1) for r, x in enumerate(near))
    return expected


def odd_codes(n, seed=2):
    """Random codes, a very common one, near copies of another, and many that share three quarters of their bits."""
    random = np.random.default_rng(seed)
    codes = random.integers(-(2**63), 2**63 - 1, n, dtype=np.int64)
    part = n // 6
    codes[part : 2 * part] = codes[0]
    codes[2 * part : 3 * part] = codes[1] ^ (np.int64(1) << random.integers(0, 62, part))
    codes[3 * part : 5 * part] = (codes[2] & ~np.int64(0xFFFF)) | random.integers(0, 1 << 16, 2 * part)
    return [(int(i), int(c)) for i, c in enumerate(codes)]


@pytest.mark.parametrize(("n", "k"), [(300, 1), (300, 7), (300, 500), (5, 3), (4000, 10)])
def test_nearest_equals_brute_force(spark, n, k):
    rows = odd_codes(n)
    rows += rows[:3]
    frame = spark.createDataFrame(rows, "id long, code long").repartition(3)
    found = topk.nearest(frame, frame.where("id % 50 = 0"), k).collect()
    assert Counter(map(tuple, found)) == brute_force(rows, [x for x in rows if x[0] % 50 == 0], k)


def test_hot_values_in_parts_and_no_blocks(spark, monkeypatch):
    """A third of the rows shares three segments; its values are cut into parts, and no query is left for the blocks."""
    monkeypatch.setattr(topk, "ROWS_PER_PART", 100)
    monkeypatch.setattr(topk, "_in_blocks", None)
    rows = odd_codes(4000, 3)
    frame = spark.createDataFrame(rows, "id long, code long")
    asked = [x for x in rows if x[0] % 50 == 0]
    found = topk.nearest(frame, frame.where("id % 50 = 0"), 10).collect()
    assert Counter(map(tuple, found)) == brute_force(rows, asked, 10)


def test_far_queries_go_to_blocks(spark, monkeypatch):
    """Queries far from all rows, with few values allowed, small blocks of rows and of queries."""
    monkeypatch.setattr(topk, "MOST_PROBES", 40)
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 2)
    rows = [(i, i * 7) for i in range(200)]
    queries = [(9000 + i, -1 - i * 11) for i in range(5)] + rows[:2]
    found = topk.nearest(spark.createDataFrame(rows, "id long, code long"), spark.createDataFrame(queries, "id long, code long"), 4).collect()
    assert Counter(map(tuple, found)) == brute_force(rows, queries, 4)


def test_probes_are_never_broadcast(spark, monkeypatch):
    """The values that queries look up outnumber them by far; by the size of the queries' files Spark would broadcast them."""
    plans, keep = {"nearest": [], "queries": []}, topk.written

    def watched(df, name):
        if name in plans:
            plans[name].append(executed_plan(df))
        return keep(df, name)

    monkeypatch.setattr(topk, "written", watched)
    rows = odd_codes(600, 4)
    frame = spark.createDataFrame(rows, "id long, code long")
    out = topk.nearest(frame, frame.where("id % 50 = 0"), 10)
    result = [line for line in executed_plan(out).split("\n") if "Join" in line]
    assert result and all("SortMergeJoin" in line for line in result)
    assert len(plans["nearest"]) > 1 and len(plans["queries"]) == len(plans["nearest"]) + 1
    for plan in plans["nearest"]:
        met = [line for line in plan.split("\n") if "Join" in line and "part#" in line]
        assert met and all("SortMergeJoin" in line for line in met)
    for plan in plans["queries"][1:]:
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert Counter(map(tuple, out.collect())) == brute_force(rows, [x for x in rows if x[0] % 50 == 0], 10)


def test_costly_lookups_give_way_to_blocks(spark, monkeypatch):
    """Queries left after radius 1 are compared in blocks, no farther than they have met k rows."""
    monkeypatch.setattr(topk, "FEW_PROBES", 100)
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 700)
    monkeypatch.setattr(topk, "FEW_QUERIES", 20)
    given, blocks = [], topk._in_blocks
    monkeypatch.setattr(topk, "_in_blocks", lambda kept, rows, asked, left, k: given.extend(asked.collect()) or blocks(kept, rows, asked, left, k))
    rows = odd_codes(3000, 5)
    frame = spark.createDataFrame(rows, "id long, code long")
    found = topk.nearest(frame, frame.where("id % 50 = 0"), 10).collect()
    assert Counter(map(tuple, found)) == brute_force(rows, [x for x in rows if x[0] % 50 == 0], 10)
    assert 0 < len(given) < 60 and any(r.far < 64 for r in given)


@pytest.mark.parametrize("n", [0, 1, 50, 30_000, 300_000])
def test_index_of_a_block(n):
    random = np.random.default_rng(n)
    codes = random.integers(0, 2**64, n, dtype=np.uint64)
    codes[: n // 3] = codes[:1].sum() ^ (np.uint64(1) << random.integers(0, 64, n // 3).astype(np.uint64))
    ids = random.permutation(n)
    index = topk.Index(codes, ids)
    for query in (0, 2**64 - 1, *(int(c) ^ 5 for c in codes[:2]), *(int(c) for c in codes[-2:])):
        distances = np.bitwise_count(codes ^ np.uint64(query)).astype(int)
        for far in (0, 2, 3, 11, 15, 18, 64):
            near = np.flatnonzero(distances <= far)
            near = near[np.lexsort((ids[near], distances[near]))][:10]
            found = index.search(query, 10, far)
            assert found[0].tolist() == ids[near].tolist() and found[1].tolist() == distances[near].tolist()


@pytest.mark.parametrize("rows", [0, 1, 10**4, 10**6, 10**9, 10**15])
def test_segments_cut_all_bits(rows):
    cuts = topk.segments(rows)
    assert [a for a, _ in cuts] == [sum(n for _, n in cuts[:i]) for i in range(len(cuts))]
    assert sum(n for _, n in cuts) == 64 and all(10 <= n <= 32 for _, n in cuts)


def test_codes_of_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [0.5, -0.5, 0.0, 2.0]), (2, [None, 1.0]), (3, []), (4, None), (None, [1.0]), (5, [1.0] * 64), (6, [nan, -1.0]), (6, [nan, -1.0])]
    found = [(r.id, r.code) for r in topk.sign_codes(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v").collect()]
    assert sorted(found) == [(1, 9), (2, 2), (3, 0), (5, -1), (6, 1), (6, 1)]


def test_long_vectors_fail(spark):
    rows = spark.createDataFrame([(1, [1.0] * 65)], "id long, v array<double>")
    with pytest.raises(Exception, match="at most 64 bits"):
        topk.sign_codes(rows, "id", "v").collect()


def test_clashing_columns_and_nulls(spark):
    rows = [(1, 5, 0, 0, 0), (2, 4, 0, 0, 0), (None, 5, 0, 0, 0), (3, None, 0, 0, 0)]
    frame = spark.createDataFrame(rows, "id long, code long, rank int, query int, distance int")
    found = topk.nearest(frame, frame, 2).collect()
    assert Counter(map(tuple, found)) == Counter([(1, 1, 0, 1), (1, 2, 1, 2), (2, 2, 0, 1), (2, 1, 1, 2)])


def test_empty_tables(spark):
    some = spark.createDataFrame([(0, 5)], "id long, code long")
    assert topk.nearest(some.limit(0), some).count() == 0 and topk.nearest(some, some.limit(0)).count() == 0
