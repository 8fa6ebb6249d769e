import datetime as dt
import shutil

import pytest
from plans import executed_plan
from pyspark.sql import functions as F

import run_reports
from tradewind.plans import bundle, refresh, spenders
from tradewind.plans.refresh import FACTS, SUMS, ReportStore
from tradewind.sources import (
    Conflict,
    Published,
    Snapshots,
    StarTables,
    read_parquet,
    side_by_side,
    table_path,
    write_table,
)

FOLDER = "/root/testdata/sf0.001"
SETTINGS = bundle.Settings(year=1997, excluded_status="P", dominant_status="F")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    return StarTables(spark, FOLDER).tables()


def batch_files(tables, folder, rule):
    """Orders by id, items and payments by the same rule shifted, written to a folder of their own."""
    for i, name in enumerate(FACTS):
        write_table(tables[name].where(F.expr(rule.format(i=i))), table_path(folder, name))
    return folder


def opened(spark, folder):
    return {name: read_parquet(spark, table_path(folder, name)) for name in FACTS}


@pytest.fixture(scope="module")
def store(spark, tables, tmp_path_factory):
    """Three batches; each one's files are gone before the next comes."""
    home = tmp_path_factory.mktemp("store")
    store = ReportStore(spark, str(home / "s"))
    for i, name in enumerate(("mon", "tue", "wed")):
        source = batch_files(tables, str(home / name), f"(order_id + {{i}}) % 3 = {i}")
        assert store.add(name, opened(spark, source))
        assert not store.add(name, opened(spark, source))
        shutil.rmtree(source)
        if i == 1:
            store.compact()
    return store


@pytest.fixture(scope="module")
def full(spark, tables, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("full"))
    names = bundle.write_reports(spark, tables, out, settings=SETTINGS)
    return {name: rows(read_parquet(spark, table_path(out, name))) for name in names}


def test_batches_give_the_tables_of_one_run(store, tables, full):
    assert store.batches() == ["mon", "tue", "wed"]
    store.refresh(tables, SETTINGS)
    assert {name: rows(store.open(name)) for name in store.published.tables()} == full


def test_a_batch_is_read_without_the_others(spark, store, tables):
    """What reports read are sums; facts appear in no plan."""
    for name in SUMS:
        plan = executed_plan(store.sums(name))
        assert "lineitem" not in plan and "orders.parquet" not in plan
    assert rows(store.month_payments(1997, "P")) == rows(
        spenders.month_payments(tables["orders"], tables["order_payments"], year=1997, excluded_status="P")
    )
    assert rows(store.month_payments(excluded_status="P")) == rows(
        spenders.month_payments(tables["orders"], tables["order_payments"], excluded_status="P")
    )


def test_late_rows_correct_old_months(spark, tmp_path):
    def frames(orders, items, payments):
        return {
            "orders": spark.createDataFrame(
                orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
                "order_delivered_carrier_date date, order_delivered_customer_date date, order_estimated_delivery_date date"
            ),
            "order_items": spark.createDataFrame(items, "order_id string, product_id string, seller_id string, price double"),
            "order_payments": spark.createDataFrame(payments, "order_id string, payment_value double"),
        }

    day = dt.datetime(2017, 3, 5, 10)
    store = ReportStore(spark, str(tmp_path))
    store.add("1", frames([("a", "c1", "ok", day, None, None, None), (None, "cx", "ok", day, None, None, None)], [], [("a", 1.25), ("b", 7.0), (None, 9.0)]))
    assert rows(store.month_payments(2017)) == [(3, "c1", 125)]
    store.add("2", frames([("b", "c2", "ok", day, None, None, None)], [("z", "p", "s", 3.0)], [("a", 2.0), ("a", -0.25)]))
    assert rows(store.month_payments(2017)) == [(3, "c1", 300), (3, "c2", 700)]
    assert rows(store.sums("seller_months")) == [] and rows(store.sums("seller_earnings")) == [("s", 300)]
    store.add("3", frames([("z", "c1", "ok", day.replace(month=4), None, None, None)], [("z", None, None, 5.0)], []))
    assert rows(store.sums("seller_months")) == [("s", dt.date(2017, 4, 1), 300)]
    assert rows(store.top_seller_months(1, since="2017-04-09")) == [("s", dt.date(2017, 4, 1), 3.0)]
    with pytest.raises(ValueError, match="earlier batch"):
        store.add("4", frames([("a", "c1", "ok", day, None, None, None)], [], []))
    assert store.batches() == ["1", "2", "3"]


def numbered_batch(spark, first, n=40):
    """Orders from a number on; each is paid, has an item, and the order n numbers later is paid and has one too."""
    day = F.lit("2017-03-05").cast("date")
    ids = spark.range(first, first + n, numPartitions=2).withColumnRenamed("id", "order_id")
    both = ids.unionByName(ids.select((F.col("order_id") + n).alias("order_id")))
    return {
        "orders": ids.select(
            "order_id", F.col("order_id").alias("customer_id"), F.lit("ok").alias("order_status"),
            *(day.alias(f"order_{c}") for c in (
                "purchase_timestamp", "delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date"
            )),
        ),
        "order_items": both.select(
            "order_id", F.col("order_id").alias("product_id"), (F.col("order_id") % 7).alias("seller_id"), F.lit(1.5).alias("price")
        ),
        "order_payments": both.select("order_id", F.lit(2.5).alias("payment_value")),
    }


def test_stored_orders_are_never_broadcast(spark, tmp_path, monkeypatch):
    """The files of the narrow rows are far smaller than the rows; by their size Spark would broadcast millions of them."""
    plans, keep = {}, refresh.materialize

    def watched(df, folder, name):
        plans.setdefault(name, []).append(executed_plan(df))
        return keep(df, folder, name)

    monkeypatch.setattr(refresh, "materialize", watched)
    store = ReportStore(spark, str(tmp_path))
    for name, first in (("a", 0), ("b", 40), ("c", 80)):
        store.add(name, numbered_batch(spark, first))
    for name in ("month_payments", "seller_months", "waiting_payments", "waiting_items"):
        assert len(plans[name]) == 3
        for plan in plans[name]:
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, name
    # Of orders 40 to 119, each paid twice, the second half's later payments wait no more.
    paid = {row.customer_id: row.paid for row in store.sums("month_payments").collect()}
    assert paid == {i: 250 if i < 40 else 500 for i in range(120)}
    waiting = store.ledger.latest()[1]["waiting"]
    assert spark.read.parquet(*waiting["payments"]).count() == spark.read.parquet(*waiting["items"]).count() == 40


def test_stored_sums_are_never_broadcast(spark, tmp_path):
    """The sums per product, seller and customer meet the lookup tables by a shuffle."""
    store = ReportStore(spark, str(tmp_path))
    store.add("a", numbered_batch(spark, 0))
    products = spark.range(80).select(F.col("id").alias("product_id"), F.lit("x").alias("product_category_name"))
    places = spark.range(7).select(
        F.col("id").alias("seller_id"), F.lit(1).alias("seller_zip_code_prefix"), F.lit("c").alias("seller_city"), F.lit("s").alias("seller_state")
    )
    tables = {
        "products": products,
        "sellers": places,
        "category_translation": spark.createDataFrame([("x", "y")], "product_category_name string, product_category_name_english string"),
        "customers": spark.range(80).select(F.col("id").alias("customer_id"), F.col("id").alias("customer_unique_id")),
    }
    settings = bundle.Settings(year=2017)
    parts = store.parts(tables, settings)
    paid = refresh.materialize(parts["month_payments"](), str(tmp_path), "paid")
    spent = bundle.spender_results({"month_payments": paid}, tables, settings)[bundle.MONTH_SPENDING_UNIQUE]
    for df, key in ((parts["sold_products"](), "product_id"), (parts["seller_sales"](), "seller_id"), (spent, "customer_id")):
        joins = [line for line in executed_plan(df).split("\n") if "Join" in line and f"[{key}#" in line]
        assert joins and all("SortMergeJoin" in line for line in joins), key


def test_no_batch_yet(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path))
    store.compact()
    assert store.batches() == []
    with pytest.raises(ValueError, match="no batch"):
        store.sums("order_summary")


def test_states_are_claimed_once(spark, tmp_path):
    one, other = Snapshots(spark, str(tmp_path)), Snapshots(spark, str(tmp_path))
    assert one.latest() == (0, {})
    assert one.commit(0, {"a": [1, "é"]}) == 1
    with pytest.raises(Conflict):
        other.commit(0, {"a": 2})
    assert other.commit(1, {"a": 3}) == 2 and one.latest() == (2, {"a": 3})
    (tmp_path / "3.json").write_text('{"a": 4}')  # a job that died while it wrote
    assert one.latest() == (2, {"a": 3}) and one.commit(2, {"a": 5}) == 4 and one.latest() == (4, {"a": 5})


def test_a_dead_run_leaves_the_old_version(spark, tmp_path):
    shop = Published(spark, str(tmp_path))
    with pytest.raises(KeyError):
        shop.open("t")
    assert shop.publish_tables({"t": spark.range(3), "u": spark.range(1)}) == 1

    def dies(folder):
        write_table(spark.range(100), table_path(folder, "t"))
        raise RuntimeError("killed between two tables")

    with pytest.raises(RuntimeError):
        shop.publish(dies)
    assert shop.open("t").count() == 3
    before = shop.open("t")
    assert shop.publish_tables({"t": spark.range(5)}) == 2
    assert before.count() == 3 and shop.open("t").count() == 5 and shop.open("u").count() == 1
    assert shop.tables() == ["t", "u"] and shop.open("t", version=1).count() == 3
    assert len(shop.remove_old(keep=2)) == 1 and before.count() == 3  # the dead run's
    assert shop.remove_old(keep=1) == [] and shop.open("u").count() == 1  # version 2 still names u of version 1
    shop.publish_tables({"u": spark.range(2)})
    assert len(shop.remove_old(keep=1)) == 1 and shop.open("t").count() == 5


def test_side_by_side_raises_the_failure(spark):
    done = []

    def fails():
        raise ValueError("one of them")

    with pytest.raises(ValueError, match="one of them"):
        side_by_side(spark, [lambda: done.append(1), fails, lambda: done.append(2)], threads=2)
    assert sorted(done) == [1, 2] and side_by_side(spark, []) == []


def test_command_line(spark, tables, full, tmp_path):
    lookups = {n: tables[n] for n in ("customers", "products", "category_translation", "sellers", "geolocation")}
    for name, rule in (("a", "order_id % 2 = 0"), ("b", "order_id % 2 = 1")):
        source = batch_files(tables, str(tmp_path / name), rule)
        for table, df in lookups.items():
            write_table(df, table_path(source, table))
        run_reports.main(["--parquet", source, "--store", str(tmp_path / "store"), "--batch", name, "--year", "1997"])
    store = ReportStore(spark, str(tmp_path / "store"))
    assert store.batches() == ["a", "b"]
    for name in (bundle.DELAY_HISTOGRAM, bundle.TOP_PRODUCTS, bundle.BEST_SELLERS_CITY):
        assert rows(store.open(name)) == full[name]
    with pytest.raises(SystemExit):
        run_reports.arguments(["--parquet", "x", "--store", "y"])
    with pytest.raises(SystemExit):
        run_reports.arguments(["--parquet", "x"])
