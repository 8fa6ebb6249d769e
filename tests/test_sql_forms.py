"""The same questions asked in Spark SQL over views give the same rows."""

import pytest
from testdata import TESTDATA

from tradewind.plans import categories, delivery, spenders, status
from tradewind.sources import StarTables


@pytest.fixture(scope="module")
def tables(spark):
    return StarTables(spark, str(TESTDATA / "sf0.001")).tables()


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_delay_histogram(spark, tables):
    sql = spark.sql(
        """
        SELECT days_delayed, count(*) AS no_orders
        FROM (SELECT date_diff(to_date(order_delivered_customer_date), order_estimated_delivery_date) AS days_delayed
              FROM {orders} WHERE order_estimated_delivery_date < to_date(order_delivered_customer_date))
        GROUP BY days_delayed ORDER BY days_delayed
        """,
        orders=tables["orders"],
    )
    assert sql.collect() == delivery.delay_histogram(delivery.delay_profile(tables["orders"])).collect()


def test_top_products(spark, tables):
    for name in ("order_items", "products", "category_translation"):
        tables[name].createOrReplaceTempView(f"sql_forms_{name}")
    sql = spark.sql(
        """
        WITH sold AS (
            SELECT product_category_name_english AS product_category_name, product_id, count(product_id) AS together
            FROM sql_forms_order_items JOIN sql_forms_products USING (product_id)
            JOIN sql_forms_category_translation USING (product_category_name)
            GROUP BY ALL
        )
        SELECT product_category_name, product_id, together
        FROM (SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY together DESC, product_id) AS n
              FROM sold)
        WHERE n < 4 AND product_category_name IN (
            SELECT product_category_name FROM sold GROUP BY 1 ORDER BY sum(together) DESC, 1 LIMIT 10)
        """
    )
    sold = categories.sold_products(tables["order_items"], tables["products"], tables["category_translation"])
    assert rows(sql) == rows(categories.top_products_numbered(sold).drop("product_number"))


def test_largest_payments(spark, tables):
    sql = spark.sql(
        """
        WITH largest AS (
            SELECT customer_id, extract(month FROM order_purchase_timestamp) AS month,
                   extract(year FROM order_purchase_timestamp) AS year, max(payment_value) AS max_cash
            FROM {payments} JOIN {orders} USING (order_id) GROUP BY customer_id, month, year
        )
        SELECT customer_id, month, year, max_cash
        FROM (SELECT *, row_number() OVER (PARTITION BY year, month ORDER BY max_cash DESC, customer_id) AS n FROM largest)
        WHERE n = 1 AND year = '1997'
        """,
        orders=tables["orders"],
        payments=tables["order_payments"],
    )
    assert rows(sql) == rows(spenders.max_payment_by_month(tables["orders"], tables["order_payments"], year=1997))


def test_orders_per_status(spark, tables):
    sql = spark.sql(
        "SELECT order_status, count(order_status) AS amount FROM {orders} GROUP BY order_status", orders=tables["orders"]
    )
    assert rows(sql) == rows(status.orders_per_status(tables["orders"]))
