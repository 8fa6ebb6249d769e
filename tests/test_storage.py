import re

import pytest
from plans import executed_plan
from pyspark.sql import functions as F

from tradewind.plans import spenders
from tradewind.sources import (
    KEYS,
    OrderBuckets,
    StarTables,
    TooDamaged,
    counted,
    ingest,
    open_tables,
    read_parquet,
    table_path,
    write_order_buckets,
    write_table,
)

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def hot(spark):
    """40,000 payments, a third of them, all alike, of one order."""
    orders = spark.range(0, 6000, 1, 4).selectExpr(
        "concat('o', id) AS order_id", "concat('c', id % 900) AS customer_id", "if(id % 9 = 0, 'canceled', 'ok') AS order_status",
        "timestamp_ntz '2017-01-15 10:00:00' + make_dt_interval(cast(id % 700 as int)) AS order_purchase_timestamp",
    )
    payments = spark.range(0, 40_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 'o7', if(id % 1000 = 1, null, concat('o', id % 6000))) AS order_id",
        "if(id % 3 = 0, 1.25, id % 977 / 4) AS payment_value",
    )
    return orders, payments


@pytest.fixture(scope="module")
def store(spark, hot, tmp_path_factory):
    orders, payments = hot
    return write_order_buckets(spark, orders, {"order_payments": payments}, str(tmp_path_factory.mktemp("b")), 16)


def test_joins_of_buckets_shuffle_nothing(spark, no_broadcast, store, hot):
    for plan, single in (
        (lambda o, p, **k: spenders.month_payments(o, p, year=2017, **k), "month"),
        (spenders.max_payment_by_month, "max"),
    ):
        found = plan(store.placed, store.facts("order_payments"), keys=KEYS)
        lines = executed_plan(found).split("\n")
        join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
        assert not any("Exchange" in line for line in lines[join:]), single
        assert rows(found) == rows(plan(*hot))


def test_a_hot_order_is_dealt_to_buckets(store):
    sizes = sorted(r["count"] for r in store.facts("order_payments").groupBy(F.input_file_name()).count().collect())
    assert len(sizes) == 16 and sum(sizes) == 40_000
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert store.placed.where("order_id = 'o7'").count() > 5
    assert store.orders.where("order_id = 'o7'").count() == 1 and store.orders.count() == 6000


def test_buckets_are_opened_by_another_session(spark, store, hot):
    other = OrderBuckets(spark.newSession(), store.folder)
    assert rows(other.facts("order_payments").drop("sub_bucket")) == rows(hot[1])
    other.forget()
    assert rows(store.orders) == rows(hot[0])


def test_buckets_of_nothing(spark, hot, tmp_path):
    orders, payments = hot
    store = write_order_buckets(spark, orders.limit(0), {"p": payments.limit(0)}, str(tmp_path), 3)
    assert store.orders.count() == 0 and store.facts("p").count() == 0
    store.forget()


def test_counts_come_from_the_write(spark, tmp_path):
    """The table is counted by the job that writes it."""
    df = spark.createDataFrame([(1, "b", None, [1]), (None, "a", 2.5, None)], "`n x` int, s string, d double, l array<int>")
    reads = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    found = counted(df.mapInArrow(passing, df.schema), lambda x: write_table(x, str(tmp_path / "t")))
    assert reads.value == 2 and found.rows == 2
    assert {c: (v.nulls, v.least, v.largest) for c, v in found.columns.items()} == {
        "n x": (1, 1, 1), "s": (0, "a", "b"), "d": (1, 2.5, 2.5), "l": (1, None, None)
    }
    assert read_parquet(spark, str(tmp_path / "t")).count() == 2
    none = counted(df.limit(0), lambda x: write_table(x, str(tmp_path / "u")))
    assert none.rows == 0 and none.columns["s"].nulls == 0 and none.columns["s"].least is None


PAYMENTS = '''order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,card,2,10.5
o2,one,card,2,10.5
o3,1,card
o4,1,card,,
o5,2,"a, ""b""",3,x
o6,1,card,1,1,1
o7,1,card,1,99.9
'''


def test_damaged_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "p.csv").write_text(PAYMENTS)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    paths = {"order_payments": str(tmp_path / "p.csv")}
    counts = ingest(spark, paths, good, quarantine=bad, most_damaged=0.6, escape='"')
    table = open_tables(spark, good, ["order_payments"])["order_payments"]
    assert [r.order_id for r in table.orderBy("order_id").collect()] == ["o1", "o4", "o7"]
    assert counts["order_payments"].rows == 3 and counts["order_payments"].columns["payment_value"].nulls == 1
    aside = read_parquet(spark, table_path(bad, "order_payments"))
    assert {r.record.split(",")[0]: r.reason for r in aside.collect()} == {
        "o2": "payment_sequential is no int: one", "o3": "not 5 values", "o5": "payment_value is no double: x", "o6": "not 5 values"
    }
    assert all(re.search(r"/p\.csv$", r.file) for r in aside.collect())
    (tmp_path / "p.csv").write_text(PAYMENTS.replace("o7", "o8"))
    with pytest.raises(TooDamaged, match="4 of 7"):
        ingest(spark, paths, good, quarantine=bad, most_damaged=0.5, escape='"')
    assert open_tables(spark, good, ["order_payments"])["order_payments"].where("order_id = 'o7'").count() == 1
    (tmp_path / "p.csv").write_text("\n".join(PAYMENTS.split("\n")[:2]))
    ingest(spark, paths, good, quarantine=bad)
    assert open_tables(spark, good, ["order_payments"])["order_payments"].count() == 1
    assert [p.name for p in (tmp_path / "good").iterdir()] == ["order_payments.parquet"]
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        (tmp_path / "p.csv").write_text(PAYMENTS)
        ingest(spark, paths, good, escape='"')


def test_buckets_of_the_test_tables(spark, tmp_path):
    t = StarTables(spark, FOLDER)
    store = write_order_buckets(spark, t.orders, {"order_items": t.order_items}, str(tmp_path), 4)
    assert store.facts("order_items").count() == t.order_items.count() and rows(store.orders) == rows(t.orders)
    store.forget()
