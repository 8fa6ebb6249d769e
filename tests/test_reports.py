"""The reports on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewind.plans import categories, delivery, sellers, shipping, spenders, status


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def orders(spark):
    rows = [
        # id, customer, status, bought; then handed over, delivered, promised
        ("o1", "c1", "delivered", "2017-01-05 10:00:00") + ("2017-01-07 08:00:00", "2017-01-10 23:00:00", "2017-01-10 00:00:00"),
        ("o2", "c2", "delivered", "2017-01-06 10:00:00") + ("2017-01-08 08:00:00", "2017-01-11 01:00:00", "2017-01-10 00:00:00"),
        ("o3", "c3", "delivered", "2017-02-01 10:00:00") + ("2017-02-20 08:00:00", "2017-02-28 01:00:00", "2017-02-18 00:00:00"),
        ("o4", "c4", "canceled", "2017-02-02 10:00:00") + (None, None, "2017-02-18 00:00:00"),
        ("o5", "c5", None, "2018-03-01 10:00:00") + ("2018-03-03 10:00:00", None, "2018-03-20 00:00:00"),
        ("o6", "c1", "delivered", "2017-12-31 23:59:59") + ("2018-01-02 10:00:00", "2018-01-03 10:00:00", None),
    ]
    names = "order_id customer_id order_status order_purchase_timestamp order_delivered_carrier_date".split()
    names += ["order_delivered_customer_date", "order_estimated_delivery_date"]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_delays(orders):
    assert found(delivery.order_delay(orders)) == [("o2", 1), ("o3", 10)]
    days = delivery.delay_profile(orders)
    assert [tuple(r) for r in delivery.delay_histogram(days).collect()] == [(1, 1), (10, 1)]
    structure = {"Delivered": 2, "Delayed": 2, "Undelivered": 2}
    assert {r["order_type"]: r["count"] for r in delivery.order_structure(days).collect()} == structure
    chart = delivery.order_structure(days, delivery.CHART_ORDER_TYPES)
    assert {r["order_type"] for r in chart.collect()} == set(delivery.CHART_ORDER_TYPES)
    totals = delivery.delay_totals(days).first()
    assert (totals.orders, totals.delayed, totals.undelivered, totals.delayed_or_undelivered) == (6, 2, 2, 4)
    assert totals.delayed_percent == pytest.approx(100 / 3)
    assert delivery.delayed_exactly(days, 10).first()[0] == 1
    assert delivery.delayed_exactly(days, -5).first()[0] == 0
    assert found(delivery.delay_percentage(days, first_n=1)) == [(1, 1, 50.0)]
    assert found(delivery.delay_percentage(days, day_range=(2, 50))) == [(10, 1, 50.0)]


def test_delay_summary_has_the_form_of_describe(orders):
    days = delivery.delay_profile(orders)
    wanted = delivery.order_delay(orders).describe("days_delayed")
    assert delivery.delay_summary(days).columns == wanted.columns
    assert [tuple(r) for r in delivery.delay_summary(days).collect()] == [tuple(r) for r in wanted.collect()]


def test_delay_numbers_of_no_orders(orders):
    days = delivery.delay_profile(orders.limit(0))
    assert {r["count"] for r in delivery.order_structure(days).collect()} == {0}
    assert delivery.delay_totals(days).first().delayed_percent is None
    assert tuple(delivery.delay_stats(days).first()) == (0, None, None, None, None)
    one = delivery.delay_stats(delivery.delay_profile(orders.filter("order_id = 'o2'"))).first()
    assert (one["count"], one.mean, one.stddev) == (1, 1.0, None)


def test_shipping_is_strict(spark):
    rows = [
        ("exactly", "2017-01-01", "2017-01-03"), ("more", "2017-01-01", "2017-01-04"), ("late", "2017-01-09", "2017-01-04"),
        ("not sent", None, "2017-01-04"), ("no promise", "2017-01-01", None), (None, "2017-01-01", "2017-01-09"),
    ]
    orders = spark.createDataFrame(
        rows, "order_id string, order_delivered_carrier_date string, order_estimated_delivery_date string"
    ).withColumns({c: F.concat(F.col(c), F.lit(" 12:00:00")) for c in
                   ("order_delivered_carrier_date", "order_estimated_delivery_date")})
    flags = shipping.ship_ahead_flag(orders)
    assert {r.order_id: (r.two_days, r.critical) for r in flags.collect()} == {
        "exactly": (False, True), "more": (True, False), "late": (False, True)
    }
    counts = shipping.with_ship_label(shipping.ship_ahead_counts(flags))
    labels = {r.two_days: (r["count"], r.label) for r in counts.collect()}
    assert labels == {True: (1, shipping.SHIPPED_EARLY), False: (2, shipping.SHIPPED_LATE)}


def test_status(orders):
    amounts = status.orders_per_status(orders)
    assert found(amounts) == sorted([("delivered", 4), ("canceled", 1), (None, 1)], key=str)
    assert tuple(status.delivered_share(amounts).first()) == (6, 4, 4 / 6)
    assert found(status.without_status(amounts)) == sorted([("canceled", 1), (None, 1)], key=str)


@pytest.fixture
def sold(spark):
    sales = ["p1"] * 5 + ["p2"] * 3 + ["p3"] * 3 + ["p4"] * 3 + ["p5", "p6", None, "p8"]
    items = spark.createDataFrame([(p,) for p in sales], "product_id string")
    products = spark.createDataFrame(
        [("p1", "a"), ("p2", "b"), ("p3", "b"), ("p4", "b"), ("p5", "b"), ("p6", None), ("p7", "a"), ("p8", "zz")],
        "product_id string, product_category_name string",
    )
    names = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")],
                                  "product_category_name string, product_category_name_english string")
    return categories.sold_products(items, products, names)


def test_categories(sold):
    assert found(categories.items_per_category(sold)) == [("A", 5), ("B", 10)]
    assert found(categories.category_list(sold)) == [("A",), ("B",)]
    assert [tuple(r) for r in categories.top_categories_rest(sold, 1).collect()] == [(10, "B"), (5, "rest")]
    assert tuple(categories.category_count(sold, 1).first()) == (2, 1)
    assert tuple(categories.category_count(sold).first()) == (2, 2)
    share = categories.category_share(sold, 1).first()
    assert (share["items"], share.top_items, share.top_percent) == (15, 10, pytest.approx(200 / 3))


def test_products(sold):
    assert found(categories.top_products(sold)) == [("A", "p1", 5), ("B", "p2", 3), ("B", "p3", 3), ("B", "p4", 3)]
    assert found(categories.top_products_numbered(sold, n=2, categories=1)) == [("B", "p2", 3, "1"), ("B", "p3", 3, "2")]


@pytest.fixture
def payments(spark):
    rows = [("o1", 10.1), ("o1", 20.2), ("o2", 25.0), ("o3", 5.0), ("o4", 999.0), ("o5", 7.0), ("o6", 1.0), ("o9", 50.0)]
    return spark.createDataFrame(rows, "order_id string, payment_value double")


def test_largest_payments(orders, payments):
    rows = found(spenders.max_payment_by_month(orders, payments))
    assert rows == [("c1", 12, 2017, 1.0), ("c2", 1, 2017, 25.0), ("c4", 2, 2017, 999.0), ("c5", 3, 2018, 7.0)]
    in_2017 = spenders.max_payment_by_month(orders, payments, year=2017)
    assert found(in_2017) == [r for r in rows if r[2] == 2017]
    assert spenders.winner_count(in_2017).first()[0] == 3
    assert spenders.latest_purchase(orders, payments).first()[0] == dt.date(2018, 3, 1)


def test_month_spending(spark, orders, payments):
    paid = spenders.month_payments(orders, payments)  # the newest order is of 2018, so 2017
    best = [(1, "c1", 30.3), (2, "c3", 5.0), (12, "c1", 1.0)]
    assert [tuple(r) for r in spenders.month_spending(paid).collect()] == best
    in_2017 = spenders.month_payments(orders, payments, year=2017)
    assert [tuple(r) for r in spenders.month_spending(in_2017).collect()] == best
    labels = spenders.with_month_label(spenders.month_spending(paid))
    assert [r.month_label for r in labels.collect()] == ["Jan", "Feb", "Dec"]

    people = [("c1", "u1"), ("c2", "u2"), ("c3", "u2"), ("c4", "u4"), ("c5", "u2"), ("c7", "u1")]
    customers = spark.createDataFrame(people, "customer_id string, customer_unique_id string")
    unique = spenders.month_spending_unique(paid, customers)
    assert [tuple(r) for r in unique.collect()] == [
        (1, "u1", 30.3, "c1"), (1, "u1", 30.3, "c7"), (2, "u2", 5.0, "c2"), (2, "u2", 5.0, "c3"), (2, "u2", 5.0, "c5"),
        (12, "u1", 1.0, "c1"), (12, "u1", 1.0, "c7"),
    ]
    assert found(spenders.status_list(orders)) == sorted([("delivered",), ("canceled",), (None,)], key=str)


@pytest.fixture
def market(spark):
    items = spark.createDataFrame(
        [("o1", "s1", 10.5), ("o2", "s1", 9.5), ("o3", "s2", 20.0), ("o4", "s3", 5.0), ("o5", "s4", 1.0), ("o6", "s5", 3.0),
         ("o7", None, 500.0), ("o8", "gone", 4.0)],
        "order_id string, seller_id string, price double",
    )
    places = spark.createDataFrame(
        [("s1", 10, "X", "A"), ("s2", 10, "X", "A"), ("s3", 11, "X", "B"), ("s4", 12, "Y", "A"), ("s5", 99, "Z", "C"),
         ("idle", 10, "X", "A")],
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
    )
    geo = spark.createDataFrame(
        [(10, 1.0, -1.0), (10, 3.0, -3.0), (11, 8.0, -8.0), (12, 5.0, None)],
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double",
    )
    return items, places, geo


def test_top_sellers(market):
    items, places, _ = market
    sales = sellers.seller_sales(items, places)
    assert [tuple(r) for r in sellers.top_sellers(sales, "seller_state", 1).collect()] == [
        ("s1", "A", 20.0), ("s2", "A", 20.0), ("s3", "B", 5.0), ("s5", "C", 3.0)
    ]
    assert found(sellers.best_sellers_wide(sales, "seller_state")) == [
        ("A", "s1", "s2"), ("B", "s3", sellers.ONE_SELLER["seller_state"]), ("C", "s5", sellers.ONE_SELLER["seller_state"])
    ]
    both = sellers.top_sellers(sales, ["seller_city", "seller_state"], 2)
    assert both.columns == ["seller_id", "seller_city", "seller_state", "revenue"] and both.count() == 5


def test_place_totals(market):
    items, places, geo = market
    sales = sellers.seller_sales(items, places)
    states = sellers.state_totals(sales, geo)
    assert states.columns == ["seller_state", "revenue", "count", "lat", "lng"]
    assert [r.seller_state for r in states.collect()] == ["C", "B", "A"]
    by_state = {r.seller_state: tuple(r)[1:] for r in states.collect()}
    # A: two sellers at mean (2, -2), one at (5, unknown); C: unknown zip code.
    assert by_state == {"A": (41.0, 3, 3.0, -2.0), "B": (5.0, 1, 8.0, -8.0), "C": (3.0, 1, None, None)}
    cities = sellers.with_count_bands(sellers.city_totals(sales, geo))
    by_city = {r.seller_city: tuple(r)[1:] for r in cities.collect()}
    assert by_city["X"] == (45.0, 3, 4.0, -4.0, 1, "#66CF83")
    assert dict(cities.dtypes)["size"] == "bigint"
    joined = sellers.map_dataset(cities, sellers.best_sellers_wide(sales, "seller_city"))
    assert {r.seller_city: r["2_best_seller"] for r in joined.collect()}["X"] == "s2"
    assert sellers.with_revenue_bands(states).first().revenue_band == 5


def test_null_places(spark, market):
    items, places, geo = market
    unknown = F.when(F.col("seller_city") != "X", F.col("seller_city"))
    sales = sellers.seller_sales(items, places.withColumn("seller_city", unknown))
    by_state = {r.seller_state: r["count"] for r in sellers.state_totals(sales, geo).collect()}
    assert by_state == {"A": 1, "B": 0, "C": 1}
    assert {r.seller_id for r in sellers.top_sellers(sales, "seller_city", 1).collect()} == {"s1", "s2", "s4", "s5"}


def test_top_seller_months(spark, market):
    items, _, _ = market
    days = ["2016-09-01", "2017-07-01", "2017-09-01", "2018-01-01", "2018-01-01", "2018-01-01", "2018-01-01", "2018-01-01"]
    orders = spark.createDataFrame(
        [(f"o{i}", f"{day} 00:00:00") for i, day in enumerate(days, 1)], "order_id string, order_purchase_timestamp string"
    )
    months = sellers.top_seller_months(items, orders, 2)
    assert [tuple(r) for r in months.collect()] == [("s1", dt.date(2016, 9, 1), 10.5), ("s2", dt.date(2017, 9, 1), 20.0)]
    since = sellers.top_seller_months(items, orders, 3, since="2017-08-01")
    assert found(since) == [("s2", dt.date(2017, 9, 1), 20.0), ("s3", dt.date(2018, 1, 1), 5.0)]
