import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import run_reports
from tradewind.plans import bundle, categories, delivery, sellers, shipping, spenders, status
from tradewind.sources import SCHEMAS, StarTables, read_parquet, table_path

# Names and columns of the result tables.
TOTALS = "revenue double, count bigint, lat double, lng double, size bigint, colors string"
SCHEMA = {
    bundle.DELAY_HISTOGRAM: "days_delayed int, no_orders bigint",
    bundle.DELAY_STATISTICS: "summary string, days_delayed string",
    bundle.ORDER_STRUCTURE: "order_type string, count bigint",
    bundle.TOP_CATEGORIES: "count bigint, product_category_name string",
    bundle.TOP_PRODUCTS: "product_category_name string, product_id string, together bigint",
    bundle.TOP_PRODUCTS_NUMBERED: "product_category_name string, product_id string, together bigint, product_number string",
    bundle.CATEGORIES: "product_category_name string",
    bundle.MONTH_SPENDING: "order_purchase_month int, customer_id string, month_payment double",
    bundle.MONTH_SPENDING_UNIQUE: "order_purchase_month int, customer_unique_id string, month_payment double, "
    "customer_id string",
    bundle.BEST_SELLERS_STATE: "seller_state string, 1_best_seller string, 2_best_seller string",
    bundle.BEST_SELLERS_CITY: "seller_city string, 1_best_seller string, 2_best_seller string",
    bundle.STATE_SALES: f"seller_state string, {TOTALS}",
    bundle.CITY_SALES: f"seller_city string, {TOTALS}",
    bundle.ORDERS_PER_STATUS: "order_status string, amount bigint",
    bundle.SHIP_AHEAD: "two_days boolean, count bigint",
    bundle.OTHER_STATUSES: "order_status string, amount bigint",
    bundle.CITY_MAP: f"seller_city string, {TOTALS}, 1_best_seller string, 2_best_seller string",
}


@pytest.fixture(scope="module")
def csv_folder(tmp_path_factory):
    """Nine small CSV files with the real columns."""
    folder = tmp_path_factory.mktemp("csv")

    def day(n):
        return (dt.datetime(2017, 1, 1, 12) + dt.timedelta(days=n)).strftime("%Y-%m-%d %H:%M:%S")

    rows = {name: [] for name in SCHEMAS}
    for i in range(120):
        status = "canceled" if i % 10 == 0 else "delivered"
        sent, came = ("", "") if i % 10 == 0 else (day(5 * i + 2), day(5 * i + 4 + i % 9))
        rows["orders"].append((f"o{i}", f"c{i}", status, day(5 * i), day(5 * i), sent, came, day(5 * i + 8)))
        rows["customers"].append((f"c{i}", f"u{i % 17}", 1000 + i % 5, "town", "ST"))
        for j in range(1 + i % 3):
            rows["order_items"].append((f"o{i}", j, f"p{(i * j) % 23}", f"s{i % 7}", day(i), 10 + i + j / 100, 1.5))
            rows["order_payments"].append((f"o{i}", j, "card", 1, 12.25 + i + j))
        rows["order_reviews"].append((f"r{i}", f"o{i}", 5, "", "fine", day(i), day(i)))
    rows["products"] = [(f"p{i}", f"cat{i % 12}", 1, 1, 1, 1, 1, 1, 1) for i in range(23)]
    rows["sellers"] = [(f"s{i}", 2000 + i, f"city{i % 4}", f"S{i % 2}") for i in range(7)]
    rows["geolocation"] = [(2000 + i % 6, -20 - i, -40 - i, "x", "y") for i in range(30)]
    rows["category_translation"] = [(f"cat{i}", f"category {i}") for i in range(12)]
    for name, lines in rows.items():
        header = ",".join(StructType.fromDDL(SCHEMAS[name]).names)
        text = "\n".join([header] + [",".join(map(str, line)) for line in lines]) + "\n"
        (folder / f"shop_{name}.csv").write_text(text)
    return folder


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_batch_job(spark, csv_folder, tmp_path, capsys, monkeypatch):
    from_csv, from_parquet = str(tmp_path / "a"), str(tmp_path / "b")
    common = ["--csv", str(csv_folder), "--prefix", "shop_"]
    run_reports.main([*common, "--output", from_csv])
    assert set(capsys.readouterr().out.split()) == set(SCHEMA)
    run_reports.main([*common, "--ingest", str(tmp_path / "tables"), "--orders-by-year", "--output", from_parquet])
    for name, ddl in SCHEMA.items():
        result = read_parquet(spark, table_path(from_csv, name))
        assert result.dtypes == [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl)], name
        assert rows(result) == rows(read_parquet(spark, table_path(from_parquet, name))), name
    assert bundle.report_map(spark, from_csv).columns == [
        "seller_city", "revenue", "count", "lat", "lng", "size", "colors", "1_best_seller", "2_best_seller"
    ]
    assert rows(bundle.report_statuses(spark, from_csv)) == [("canceled", 12)]

    only = str(tmp_path / "c")
    orders = f"orders={tmp_path / 'tables' / 'orders.parquet'}"
    for table in ("order_payments", "customers"):
        read_parquet(spark, table_path(str(tmp_path / "tables"), table)).write.parquet(str(tmp_path / f"named/a_{table}_b.parquet"))
    run_reports.main(
        ["--parquet", str(tmp_path / "named"), "--prefix", "a_", "--suffix", "_b", "--file", orders]
        + ["--output", only, "--families", "spenders", "--year", "2018"]
    )
    with pytest.raises(SystemExit):
        run_reports.arguments(["--parquet", "x", "--ingest", "y", "--output", "z"])
    assert sorted(p.name for p in (tmp_path / "c").iterdir()) == [f"{n}.parquet" for n in
                                                                (bundle.MONTH_SPENDING, bundle.MONTH_SPENDING_UNIQUE)]


def test_a_family_needs_its_own_tables_only(spark, csv_folder, tmp_path):
    assert set(bundle.NEEDED_TABLES) == set(bundle.FAMILIES)
    for family in bundle.FAMILIES:
        alone = tmp_path / family
        alone.mkdir()
        for table in bundle.needed_tables([family]):
            (alone / f"{table}.csv").write_bytes((csv_folder / f"shop_{table}.csv").read_bytes())
        run_reports.main(["--csv", str(alone), "--output", str(tmp_path / "out"), "--families", family])
    assert {p.name.removesuffix(".parquet") for p in (tmp_path / "out").iterdir()} == set(SCHEMA)


def test_bundle_equals_single_reports(spark, tmp_path):
    tables = StarTables(spark, "/root/testdata/sf0.001").tables()
    out = str(tmp_path)
    settings = bundle.Settings(year=1997, excluded_status="P")
    names = bundle.write_reports(spark, tables, out, settings=settings)
    assert sorted(names) == sorted(SCHEMA)
    orders, days = tables["orders"], delivery.delay_profile(tables["orders"])
    sold = categories.sold_products(tables["order_items"], tables["products"], tables["category_translation"])
    paid = spenders.month_payments(orders, tables["order_payments"], year=1997, excluded_status="P")
    sales = sellers.seller_sales(tables["order_items"], tables["sellers"])
    single = {
        bundle.DELAY_HISTOGRAM: delivery.delay_histogram(days),
        bundle.DELAY_STATISTICS: delivery.delay_summary(days),
        bundle.ORDER_STRUCTURE: delivery.order_structure(days),
        bundle.ORDERS_PER_STATUS: status.orders_per_status(orders),
        bundle.SHIP_AHEAD: shipping.ship_ahead_counts(shipping.ship_ahead_flag(orders)),
        bundle.TOP_CATEGORIES: categories.top_categories_rest(sold),
        bundle.TOP_PRODUCTS: categories.top_products(sold),
        bundle.TOP_PRODUCTS_NUMBERED: categories.top_products_numbered(sold),
        bundle.CATEGORIES: categories.category_list(sold),
        bundle.MONTH_SPENDING: spenders.month_spending(paid),
        bundle.MONTH_SPENDING_UNIQUE: spenders.month_spending_unique(paid, tables["customers"]),
        bundle.BEST_SELLERS_STATE: sellers.best_sellers_wide(sales, "seller_state"),
        bundle.BEST_SELLERS_CITY: sellers.best_sellers_wide(sales, "seller_city"),
    }
    for name, df in single.items():
        assert rows(read_parquet(spark, table_path(out, name))) == rows(df), name
    # Sums and counts that must agree between the results.
    assert sum(r[1] for r in rows(single[bundle.ORDER_STRUCTURE])) == orders.count()
    assert sum(r[1] for r in rows(single[bundle.ORDERS_PER_STATUS])) == orders.count()
    assert sum(r[0] for r in single[bundle.TOP_CATEGORIES].collect()) == sold.agg(F.sum("together")).first()[0]
    delayed = dict(rows(single[bundle.ORDER_STRUCTURE]))["Delayed"]
    assert delayed == sum(r[1] for r in rows(single[bundle.DELAY_HISTOGRAM])) == delivery.delay_stats(days).first()["count"]
    known = tables["order_items"].join(tables["sellers"], "seller_id", "left_semi")
    total = known.agg(F.sum(F.col("price").cast("decimal(18,2)"))).first()[0]
    states = sellers.state_totals(sales, tables["geolocation"])
    assert round(sum(r.revenue for r in states.collect()), 2) == float(total)
    by_person = {r[0]: r[2] for r in rows(single[bundle.MONTH_SPENDING_UNIQUE])}
    assert all(by_person[m] >= value for m, _, value in rows(single[bundle.MONTH_SPENDING]))


def test_sellers_listed_twice_are_refused(spark, tmp_path):
    tables = StarTables(spark, "/root/testdata/sf0.001").tables()
    tables["sellers"] = tables["sellers"].union(tables["sellers"])
    with pytest.raises(ValueError, match="seller_id is not unique"):
        bundle.write_reports(spark, tables, str(tmp_path), families=["sellers"])
