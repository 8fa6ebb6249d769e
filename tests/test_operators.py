import random
import re

import pandas as pd
import pytest
from plans import executed_plan
from pyspark.sql import functions as F

from tradewind.operators import (
    best_wide,
    count_by,
    distinct_ratio,
    duplicate_groups,
    join_spread,
    look_up,
    match_keys,
    mean_by_key,
    null_counts,
    profile,
    require_unique,
    sample_points,
    sum_by,
    top_ranked,
    top_rows,
    top_with_rest,
)

SALES = [
    ("a", "s1", 10), ("a", "s2", 10), ("a", "s3", 9), ("a", "s4", 1),
    ("b", "s5", 7), ("b", "s6", 5), ("b", "s7", 5), ("b", "s8", 4),
    ("c", "s9", 3), (None, "s0", 2),
]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(SALES, "place string, seller string, revenue long")


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_top_rows_cut_ties_by_name(sales):
    top = top_rows(sales, ["place"], "revenue", 2, tie_break=["seller"])
    assert found(top.select("place", "seller", "position")) == sorted(
        [("a", "s1", 1), ("a", "s2", 2), ("b", "s5", 1), ("b", "s6", 2), ("c", "s9", 1), (None, "s0", 1)], key=str
    )


def test_top_ranked_keeps_ties(sales):
    top = top_ranked(sales, ["place"], "revenue", 2)
    assert top.columns == sales.columns
    assert {s for _, s, _ in found(top)} == {"s1", "s2", "s5", "s6", "s7", "s9", "s0"}
    assert {s for _, s, _ in found(top_ranked(sales, [], "revenue", 3))} == {"s1", "s2", "s3"}
    assert {s for _, s, _ in found(top_ranked(sales, [], "revenue", 1))} == {"s1", "s2"}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("groups", [[], ["g"], ["g", "h"]])
def test_top_ranked_equals_rank(spark, seed, groups):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice("abc") if rng.random() > 0.1 else None, rng.randint(0, 1), rng.choice([None, 1, 2, 3, 4]))
        for i in range(60)
    ] + [(100 + i, "nulls", 0, None) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, g string, h int, m int")
    frame = pd.DataFrame(rows, columns=["id", "g", "h", "m"])
    frame["m"] = frame["m"].astype(float).fillna(-1)
    n = rng.randint(1, 20)
    keys = frame.groupby(groups, dropna=False)["m"] if groups else frame["m"]
    wanted = frame[keys.rank(method="min", ascending=False) <= n]
    assert sorted(r.id for r in top_ranked(df, groups, "m", n).collect()) == sorted(wanted["id"])


def test_top_ranked_of_nothing(sales):
    for groups in ([], ["place"]):
        assert top_ranked(sales.limit(0), groups, "revenue", 2).count() == 0


def test_best_wide_always_has_all_columns(sales):
    wide = best_wide(sales, "place", "seller", "revenue", fill="one")
    assert found(wide) == sorted([("a", "s1", "s2"), ("b", "s5", "s6"), ("c", "s9", "one"), (None, "s0", "one")], key=str)
    single = best_wide(sales.filter("place = 'c'"), "place", "seller", "revenue", fill="one")
    assert single.columns == ["place", "1_best_seller", "2_best_seller"]
    assert found(single) == [("c", "s9", "one")]


def test_top_with_rest(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 9), ("d", 1)], "name string, n long")
    assert [tuple(r) for r in top_with_rest(counts, "name", "n", 2).collect()] == [(9, "c"), (5, "a"), (6, "rest")]
    assert [tuple(r) for r in top_with_rest(counts, "name", "n", 9).collect()][-1] == (0, "rest")
    assert [tuple(r) for r in top_with_rest(counts.limit(0), "name", "n", 2).collect()] == [(0, "rest")]


def test_count_by_weights_and_nulls(spark):
    df = spark.createDataFrame([("x", 2), ("x", 3), (None, 4)], "k string, n long")
    assert found(count_by(df, "k")) == sorted([("x", 2), (None, 1)], key=str)
    assert found(count_by(df, "k", name="n", weight="n")) == sorted([("x", 5), (None, 4)], key=str)


def test_spread_joins_are_joins(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2, None, None, 3])], "k long, v long")
    few = spark.createDataFrame([(1, "a"), (None, "b"), (4, "c")], "k long, w string")
    joined = join_spread(df, few, ["k"], parts=4)
    assert joined.columns == ["k", "v", "w"]
    assert found(joined) == found(df.join(few, df["k"].eqNullSafe(few["k"])).select(df["k"], "v", "w"))


def test_rows_of_a_key_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(2000).selectExpr("if(id % 3 = 0, 1, id) AS k", "id AS v")
        plan = executed_plan(join_spread(df, spark.range(5).withColumnRenamed("id", "k"), ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?)\), ENSURE", plan)
    assert exchanges and all("_part" in e for e in exchanges)


def test_sum_by_checks_names(spark):
    df = spark.createDataFrame([("x", "p", 2.0), ("x", "q", 3.0)], "d string, e string, m double")
    assert found(sum_by(df, "d", "m", dimensions=["d", "e"], measures=["m"])) == [("x", 5.0)]
    for dimension, measure in (("m", "m"), ("d", "e")):
        with pytest.raises(ValueError):
            sum_by(df, dimension, measure, dimensions=["d", "e"], measures=["m"])


def test_mean_by_key(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (1, 4.0, None), (2, None, None)], "zip int, y double, x double")
    assert found(mean_by_key(df, "zip", lat="y", lng="x")) == [(1, 3.0, 5.0), (2, None, None)]


def test_match_keys(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    keys = spark.createDataFrame([(3,), (7,), (None,)], "k long")
    assert match_keys(df, "k", keys).count() == 20
    assert match_keys(df, "k", keys.limit(0)).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 1.0), (2, None, 1.0)], "i int, s string, d double")
    lines = {row["column"]: tuple(row)[1:] for row in profile(df, distinct=["i", "s"]).collect()}
    assert lines == {"i": ("int", 3, 0, 2), "s": ("string", 3, 1, 1), "d": ("double", 3, 1, None)}
    assert {row["rows"] for row in profile(df.limit(0), distinct=["i"]).collect()} == {0}
    assert tuple(null_counts(df).first()) == (0, 1, 1)
    assert null_counts(df, ["s"]).columns == ["s"]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "i int, s string")
    assert found(duplicate_groups(df, ["i", "s"])) == sorted([(1, "a", 2), (None, "c", 2)], key=str)
    with pytest.raises(ValueError):
        require_unique(df, "i")
    assert require_unique(df.filter("s = 'b'"), "i").count() == 1


def test_look_up_uses_the_type_of_the_column(spark):
    df = spark.createDataFrame([(24030, "x"), (1, "y")], "zip int, s string")
    assert found(look_up(df, "zip", "24030")) == [(24030, "x")]
    assert found(look_up(df, "s", "y")) == [(1, "y")]


def test_distinct_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (1.0, 3.0), (None, 3.0)], "y double, x double")
    assert tuple(distinct_ratio(df, ["y", "x"]).first()) == (4, 3, 0.75)
    assert tuple(distinct_ratio(df.limit(0), ["y", "x"]).first()) == (0, 0, None)


def test_sample(spark):
    df = spark.range(20000).select("id", F.lit(1).alias("other"))
    sample = sample_points(df, ["id"], 0.1, key=["id"], seed=1)
    ids = [r.id for r in sample.collect()]
    assert sample.columns == ["id"]
    assert 1600 < len(ids) < 2400 and len(set(ids)) == len(ids)
    assert set(ids) == {r.id for r in sample_points(df.repartition(7), ["id"], 0.1, key=["id"], seed=1).collect()}
    assert set(ids) != {r.id for r in sample_points(df, ["id"], 0.1, key=["id"], seed=2).collect()}
    assert sample_points(df, ["id"], 1.0, key=["id"]).count() == 20000
