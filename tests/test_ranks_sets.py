from collections import Counter
from itertools import groupby

import pytest
from plans import full_plan
from pyspark.sql import functions as F

from tradewind.operators import (
    complete_rank,
    fixed_sample,
    id_sets,
    merge_samples,
    positions,
    set_members,
    set_sizes,
    set_union,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def sellers(spark):
    """A third of all tie at 500, some have no revenue or place."""
    return spark.range(0, 9000, 1, 6).selectExpr(
        "id AS seller", "if(id % 50 = 0, null, concat('s', id % 4)) AS state",
        "if(id % 3 = 0, 500L, if(id % 97 = 1, null, id % 2000)) AS earned",
    )


def expected(values, groups):
    out = {}
    for _, group in groupby(sorted(values, key=lambda r: str(r[1]) if groups else ""), key=lambda r: r[1] if groups else 0):
        own = sorted(group, key=lambda r: (r[2] is None, -(r[2] or 0)))
        rank = dense = 0
        for i, r in enumerate(own):
            if i == 0 or r[2] != own[i - 1][2]:
                rank, dense = i + 1, dense + 1
            out[r[0]] = (rank, dense, (rank - 1) / (len(own) - 1) if len(own) > 1 else 0.0)
    return out


@pytest.mark.parametrize("groups", [[], ["state"]])
def test_complete_rank(spark, sellers, tmp_path, groups):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = complete_rank(sellers, "earned", str(tmp_path), groups)
        plan = full_plan(ranked)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = ranked.collect()
    want = expected([tuple(r) for r in sellers.collect()], groups)
    assert len(found) == 9000
    assert {r.seller: (r["rank"], r.dense_rank, pytest.approx(r.percent_rank)) for r in found} == want
    # Windows go by task of the ranges, never over all rows.
    assert "Exchange SinglePartition" not in plan.split("Window")[-1] and "_task" in plan


def test_positions(spark, sellers, tmp_path):
    found = positions(sellers.select("seller"), [F.desc("seller")], str(tmp_path)).collect()
    assert {r.seller: r.position for r in found} == {i: 8999 - i for i in range(9000)}
    assert positions(sellers.limit(0), ["seller"], str(tmp_path / "none")).count() == 0
    assert complete_rank(sellers.limit(0), "earned", str(tmp_path / "empty")).count() == 0


def test_sets_of_ids(spark, tmp_path):
    """One person has a third of 120,000 ids, one id belongs to two persons, some are null."""
    df = spark.range(0, 120_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 1000 = 1, null, concat('p', id % 500))) AS person", "if(id % 701 = 5, null, concat('i', id)) AS id"
    )
    df = df.union(spark.createDataFrame([("hot", "i1"), ("hot", "i3")], "person string, id string"))
    found = id_sets(df, "person", "id", str(tmp_path))
    want = {r[0]: r[1] for r in df.groupBy("person").agg(F.count_distinct("id")).collect()}
    assert {r.person: r["size"] for r in set_sizes(found).collect()} == want
    hot = found.sets.where("person = 'hot'")
    assert hot.count() in (2, 3) and hot.agg(F.max(F.octet_length("bits"))).first()[0] == 4096
    some = spark.createDataFrame([("hot",), ("p7",), (None,), ("nobody",)], "person string")
    members = set_members(found, some)
    assert rows(members) == rows(df.where("(person IN ('hot', 'p7') OR person IS NULL) AND id IS NOT NULL").distinct())
    assert set_members(found).count() == df.where("id IS NOT NULL").distinct().count()
    halves = [found.sets.where("bucket % 2 = 0"), found.sets.where("bucket % 2 = 1 OR bucket < 3")]
    merged = set_union(*halves, "person")
    assert {r.person: r["size"] for r in set_sizes(found._replace(sets=merged)).collect()} == want


def test_sample_of_fixed_size(spark):
    df = spark.range(0, 20_000, 1, 5).selectExpr("id", "if(id % 4 = 0, 9.0, if(id % 4 = 1, 1.0, if(id % 4 = 2, 0.0, null))) AS w")
    plain = rows(fixed_sample(df, 100, key=["id"]).select("id"))
    assert len(plain) == 100 == len(set(plain))
    assert plain == rows(fixed_sample(df.repartition(3), 100, key=["id"]).select("id"))
    assert plain != rows(fixed_sample(df, 100, key=["id"], seed=1).select("id"))
    parts = [fixed_sample(df.where(f"id % 7 {sign} 2"), 100, key=["id"]) for sign in ("<=", ">")]
    assert rows(merge_samples(parts, 100, key=["id"]).select("id")) == plain
    drawn = Counter(r.w for r in fixed_sample(df, 1000, key=["id"], weight="w").collect())
    assert set(drawn) == {9.0, 1.0} and 5 < drawn[9.0] / drawn[1.0] < 14
    assert fixed_sample(df.limit(3), 100, key=["id"]).count() == 3
