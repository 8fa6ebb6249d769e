"""Query registry: every report and operator over the test tables, each next to an equivalent SQL text.

The Spark side runs the library; the SQL side is written the plain way (join everything, then
group), so that the two share no shortcuts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.functions import as_date, register_sql_functions
from tradewind.operators import (
    IdSets,
    complete_rank,
    distinct_ratio,
    duplicate_groups,
    fixed_sample,
    grid_pyramid,
    id_sets,
    look_up,
    merge_samples,
    null_counts,
    profile,
    sample_points,
    set_members,
    set_sizes,
    sum_by,
)
from tradewind.plans import bundle, categories, delivery, sellers, shipping, spenders, status
from tradewind.plans.refresh import ReportStore
from tradewind.sources import (
    KEYS,
    SCHEMAS,
    OrderBuckets,
    StarTables,
    TableCounts,
    columns_at,
    counts_table,
    first_rows,
    ingest,
    open_tables,
    read_csv,
    scratch_folder,
    write_order_buckets,
)
from tradewind.sources.star import CANCELED, DELIVERED

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 1997
# Revenue and seller counts of the test tables lie outside the original bands, so the limits are scaled.
COUNT_LIMITS = (26, 22, 18, 5, 3)
REVENUE_LIMITS = (400_000_000, 300_000_000, 100_000_000, 60_000_000, 30_000_000)

ENTRIES: dict[str, tuple[Query, str | None]] = {}


def register(name: str, run: Callable[[StarTables], DataFrame], sql: str | None = None) -> None:
    ENTRIES[name] = (lambda spark, folder: run(StarTables(spark, folder)), sql)


# The input tables in SQL.
ORDERS = f"""
shipped AS (
    SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS carrier, CAST(max(l_shipdate) AS DATE) AS delivered
    FROM lineitem GROUP BY l_orderkey
),
placed AS (
    SELECT o_orderkey AS order_id, o_orderkey AS customer_id, o_custkey AS customer_unique_id,
           o_orderstatus AS order_status, CAST(o_orderdate AS DATE) AS purchased,
           CAST(o_orderdate AS DATE) + 60 AS estimated, carrier, delivered
    FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey
)"""
DELAYED = f"""{ORDERS},
late AS (
    SELECT order_id, CAST(date_diff('day', estimated, delivered) AS INTEGER) AS days_delayed
    FROM placed WHERE estimated < delivered
)"""
ITEMS = """
items AS (
    SELECT l_partkey AS product_id, 'brand_' || lpad(replace(p_brand, 'Brand#', ''), 2, '0') AS product_category_name
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_brand <> 'Brand#25'
),
per_category AS (SELECT product_category_name, count(*) AS n FROM items GROUP BY 1),
top_categories AS (
    SELECT product_category_name, n FROM per_category ORDER BY n DESC, product_category_name LIMIT 10
),
per_product AS (
    SELECT product_category_name, product_id, count(*) AS together,
           row_number() OVER (PARTITION BY product_category_name ORDER BY count(*) DESC, product_id) AS place
    FROM items GROUP BY 1, 2
)"""
PAYMENTS = f"""
paid AS (
    SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id, o_orderstatus AS order_status,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS payment
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
),
paid_in_year AS (SELECT * FROM paid WHERE year = {YEAR} AND order_status <> '{CANCELED}')"""
LARGEST = f"""{PAYMENTS},
largest AS (
    SELECT customer_id, year, month, max(payment) AS paid,
           row_number() OVER (PARTITION BY year, month ORDER BY max(payment) DESC, customer_id) AS place
    FROM paid GROUP BY customer_id, year, month
)"""
SPENDING = f"""{PAYMENTS},
per_id AS (
    SELECT month, customer_id, sum(payment) AS total,
           row_number() OVER (PARTITION BY month ORDER BY sum(payment) DESC, customer_id) AS place
    FROM paid_in_year GROUP BY month, customer_id
)"""
SALES = """
earned AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem GROUP BY 1),
sales AS (
    SELECT s_suppkey AS seller_id, s_nationkey AS zip_code, n_name AS seller_city, r_name AS seller_state, revenue
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN earned ON l_suppkey = s_suppkey
)"""


def ranked_sales(place: str) -> str:
    return f"""{SALES},
ranked AS (
    SELECT *, rank() OVER (PARTITION BY {place} ORDER BY revenue DESC) AS rnk,
           row_number() OVER (PARTITION BY {place} ORDER BY revenue DESC, seller_id) AS place_no
    FROM sales
)"""


def wide(place: str) -> str:
    return f"""
    SELECT {place}, max(CASE WHEN place_no = 1 THEN CAST(seller_id AS VARCHAR) END) AS "1_best_seller",
           coalesce(max(CASE WHEN place_no = 2 THEN CAST(seller_id AS VARCHAR) END), '{sellers.ONE_SELLER[place]}')
               AS "2_best_seller"
    FROM ranked GROUP BY {place}"""


def totals(place: str) -> str:
    return f"""
geo AS (
    SELECT c_nationkey + 5 AS zip_code, avg(c_acctbal) AS lat, avg((c_custkey % 3600) / 10 - 180) AS lng
    FROM customer GROUP BY 1
),
totals AS (
    SELECT {place}, CAST(sum(revenue) AS DOUBLE) AS revenue, count(*) AS count,
           round(avg(lat), 6) AS lat, round(avg(lng), 6) AS lng
    FROM sales LEFT JOIN geo USING (zip_code) GROUP BY {place}
)"""


def banded(column: str, limits, values) -> str:
    cases = " ".join(f"WHEN {column} > {limit} THEN {value!r}" for limit, value in zip(limits, values))
    return f"CASE {cases} ELSE {values[-1]!r} END"


COUNT_BANDS = (
    f"CAST({banded('count', COUNT_LIMITS, sellers.SIZES)} AS BIGINT) AS size, "
    f"{banded('count', COUNT_LIMITS, sellers.COLORS)} AS colors"
)


# Delivery delay.
def delays(t: StarTables) -> DataFrame:
    return delivery.delay_profile(t.orders)


register(
    "delay_histogram",
    lambda t: delivery.delay_histogram(delays(t)),
    f"WITH {DELAYED} SELECT days_delayed, count(*) AS no_orders FROM late GROUP BY 1",
)
register("order_delay", lambda t: delivery.order_delay(t.orders), f"WITH {DELAYED} SELECT * FROM late")
register(
    "delay_stats",
    lambda t: delivery.delay_stats(delays(t)).withColumns({c: F.round(c, 6) for c in ("mean", "stddev")}),
    f"""WITH {DELAYED}
    SELECT count(*) AS count, round(avg(days_delayed), 6) AS mean, round(stddev_samp(days_delayed), 6) AS stddev,
           min(days_delayed) AS min, max(days_delayed) AS max FROM late""",
)
register(
    "delay_summary",
    lambda t: delivery.delay_summary(delays(t)),
    f"""WITH {DELAYED}, n AS (
        SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(days_delayed) AS DOUBLE) AS total,
               CAST(sum(days_delayed * days_delayed) AS DOUBLE) AS squares FROM late
    )
    SELECT 'count' AS summary, CAST(count(*) AS VARCHAR) AS days_delayed FROM late
    UNION ALL SELECT 'mean', CAST(total / n AS VARCHAR) FROM n
    UNION ALL SELECT 'stddev', CAST(sqrt((squares - total * (total / n)) / (n - 1)) AS VARCHAR) FROM n
    UNION ALL SELECT 'min', CAST(min(days_delayed) AS VARCHAR) FROM late
    UNION ALL SELECT 'max', CAST(max(days_delayed) AS VARCHAR) FROM late""",
)
register(
    "order_structure",
    lambda t: delivery.order_structure(delays(t)),
    f"""WITH {ORDERS}
    SELECT CASE WHEN delivered IS NULL THEN 'Undelivered' WHEN estimated < delivered THEN 'Delayed' ELSE 'Delivered' END
               AS order_type, count(*) AS count
    FROM placed GROUP BY 1""",
)
register(
    "delay_totals",
    lambda t: delivery.delay_totals(delays(t)),
    f"""WITH {ORDERS}, n AS (
        SELECT count(*) AS orders, count(*) FILTER (WHERE estimated < delivered) AS delayed,
               count(*) FILTER (WHERE delivered IS NULL) AS undelivered FROM placed
    )
    SELECT orders, delayed, CAST(delayed AS DOUBLE) / orders * 100 AS delayed_percent,
           undelivered, CAST(undelivered AS DOUBLE) / orders * 100 AS undelivered_percent,
           delayed + undelivered AS delayed_or_undelivered,
           CAST(delayed + undelivered AS DOUBLE) / orders * 100 AS delayed_or_undelivered_percent
    FROM n""",
)
PERCENTAGE = f"""WITH {DELAYED}
    SELECT days_delayed, count(*) AS no_orders, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM late) * 100 AS percentage
    FROM late GROUP BY 1"""
register(
    "delay_percentage_first_n",
    lambda t: delivery.delay_percentage(delays(t), first_n=50),
    f"{PERCENTAGE} ORDER BY days_delayed LIMIT 50",
)
register(
    "delay_percentage_range",
    lambda t: delivery.delay_percentage(delays(t), day_range=(0, 50)),
    f"{PERCENTAGE} HAVING days_delayed BETWEEN 0 AND 50",
)
register(
    "null_counts",
    lambda t: null_counts(
        t.orders, ["order_id", "order_estimated_delivery_date", "order_delivered_customer_date"]
    ),
    f"""WITH {ORDERS}
    SELECT count(*) - count(order_id) AS order_id, count(*) - count(estimated) AS order_estimated_delivery_date,
           count(*) - count(delivered) AS order_delivered_customer_date FROM placed""",
)
register(
    "delayed_exactly",
    lambda t: delivery.delayed_exactly(delays(t), 736),
    f"WITH {DELAYED} SELECT count(*) AS no_orders FROM late WHERE days_delayed = 736",
)


# Categories and products.
def sold(t: StarTables) -> DataFrame:
    return categories.sold_products(t.order_items, t.products, t.category_translation)


register(
    "top_categories_rest",
    lambda t: categories.top_categories_rest(sold(t)),
    f"""WITH {ITEMS}
    SELECT n AS count, product_category_name FROM top_categories
    UNION ALL
    SELECT CAST((SELECT sum(n) FROM per_category) - (SELECT sum(n) FROM top_categories) AS BIGINT), 'rest'""",
)
register(
    "top_products_per_category",
    lambda t: categories.top_products(sold(t)),
    f"WITH {ITEMS} SELECT product_category_name, product_id, together FROM per_product WHERE place < 4",
)
register(
    "top_products_numbered",
    lambda t: categories.top_products_numbered(sold(t)),
    f"""WITH {ITEMS}
    SELECT product_category_name, product_id, together, CAST(place AS VARCHAR) AS product_number
    FROM per_product WHERE place < 4 AND product_category_name IN (SELECT product_category_name FROM top_categories)""",
)
register(
    "category_list",
    lambda t: categories.category_list(sold(t)),
    f"WITH {ITEMS} SELECT DISTINCT product_category_name FROM items",
)
register(
    "category_count",
    lambda t: categories.category_count(sold(t)),
    f"""WITH {ITEMS}
    SELECT count(DISTINCT product_category_name) AS no_categories,
           (SELECT count(*) FROM top_categories) AS no_top_categories FROM items""",
)
register(
    "category_share",
    lambda t: categories.category_share(sold(t)),
    f"""WITH {ITEMS}, n AS (
        SELECT count(*) AS items, CAST((SELECT sum(n) FROM top_categories) AS BIGINT) AS top_items FROM items
    )
    SELECT items, top_items, CAST(top_items AS DOUBLE) / items * 100 AS top_percent FROM n""",
)
register(
    "items_per_category",
    lambda t: categories.items_per_category(sold(t)),
    f"WITH {ITEMS} SELECT product_category_name, n AS count FROM per_category",
)


# Top-spending customers.
def paid(t: StarTables) -> DataFrame:
    return spenders.month_payments(t.orders, t.order_payments, year=YEAR, excluded_status=CANCELED)


def largest_in_year(t: StarTables) -> DataFrame:
    return spenders.max_payment_by_month(t.orders, t.order_payments, year=YEAR)


LARGEST_ROWS = "SELECT customer_id, month, year, CAST(paid AS DOUBLE) AS max_cash FROM largest WHERE place = 1"
register(
    "max_payment_by_month",
    lambda t: spenders.max_payment_by_month(t.orders, t.order_payments),
    f"WITH {LARGEST} {LARGEST_ROWS}",
)
register("max_payment_one_year", largest_in_year, f"WITH {LARGEST} {LARGEST_ROWS} AND year = {YEAR}")
SPENDING_ROWS = f"""WITH {SPENDING}
    SELECT month AS order_purchase_month, customer_id, CAST(total AS DOUBLE) AS month_payment"""
register(
    "month_spending", lambda t: spenders.month_spending(paid(t)), f"{SPENDING_ROWS} FROM per_id WHERE place = 1"
)
register(
    "month_labels",
    lambda t: spenders.with_month_label(spenders.month_spending(paid(t))),
    f"{SPENDING_ROWS}, strftime(make_date(2000, month, 1), '%b') AS month_label FROM per_id WHERE place = 1",
)
register(
    "month_spending_unique",
    lambda t: spenders.month_spending_unique(paid(t), t.customers),
    f"""WITH {PAYMENTS},
    per_person AS (
        SELECT month, customer_unique_id, sum(payment) AS total,
               row_number() OVER (PARTITION BY month ORDER BY sum(payment) DESC, customer_unique_id) AS place
        FROM paid_in_year GROUP BY month, customer_unique_id
    )
    SELECT month AS order_purchase_month, customer_unique_id, CAST(total AS DOUBLE) AS month_payment,
           CAST(o_orderkey AS VARCHAR) AS customer_id
    FROM per_person JOIN orders ON o_custkey = customer_unique_id WHERE place = 1""",
)
register(
    "latest_purchase",
    lambda t: spenders.latest_purchase(t.orders, t.order_payments),
    "SELECT CAST(max(o_orderdate) AS DATE) AS latest_purchase FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
)
register(
    "winner_count",
    lambda t: spenders.winner_count(largest_in_year(t)),
    f"WITH {LARGEST} SELECT count(DISTINCT customer_id) AS no_customers FROM largest WHERE place = 1 AND year = {YEAR}",
)
register(
    "status_list",
    lambda t: spenders.status_list(t.orders),
    "SELECT DISTINCT o_orderstatus AS order_status FROM orders",
)


# Sellers and places.
def sales(t: StarTables) -> DataFrame:
    return sellers.seller_sales(t.order_items, t.sellers)


def place_totals(t: StarTables, place: str) -> DataFrame:
    total = {"seller_state": sellers.state_totals, "seller_city": sellers.city_totals}[place]
    return total(sales(t), t.geolocation).withColumns({c: F.round(c, 6) for c in ("lat", "lng")})


def city_bands(t: StarTables) -> DataFrame:
    return sellers.with_count_bands(place_totals(t, "seller_city"), COUNT_LIMITS)


for label, place in (("state", "seller_state"), ("city", "seller_city")):
    register(
        f"top_sellers_{label}",
        lambda t, place=place: sellers.top_sellers(sales(t), place),
        f"""WITH {ranked_sales(place)}
        SELECT seller_id, {place}, CAST(revenue AS DOUBLE) AS revenue FROM ranked WHERE rnk <= 2""",
    )
    register(
        f"best_sellers_{label}_wide",
        lambda t, place=place: sellers.best_sellers_wide(sales(t), place),
        f"WITH {ranked_sales(place)} {wide(place)}",
    )
    register(
        f"{label}_totals",
        lambda t, place=place: place_totals(t, place),
        f"WITH {SALES}, {totals(place)} SELECT * FROM totals",
    )
    register(
        f"{label}_bands",
        lambda t, place=place: sellers.with_count_bands(place_totals(t, place), COUNT_LIMITS),
        f"WITH {SALES}, {totals(place)} SELECT *, {COUNT_BANDS} FROM totals",
    )
register(
    "revenue_bands",
    lambda t: sellers.with_revenue_bands(place_totals(t, "seller_city"), REVENUE_LIMITS),
    f"""WITH {SALES}, {totals('seller_city')}
    SELECT *, CAST({banded('revenue', REVENUE_LIMITS, range(6))} AS INTEGER) AS revenue_band FROM totals""",
)
register(
    "city_map_dataset",
    lambda t: sellers.map_dataset(city_bands(t), sellers.best_sellers_wide(sales(t), "seller_city")),
    f"""WITH {ranked_sales('seller_city')}, {totals('seller_city')}, wide AS ({wide('seller_city')})
    SELECT *, {COUNT_BANDS} FROM totals LEFT JOIN wide USING (seller_city)""",
)
register(
    "top_seller_months",
    lambda t: sellers.top_seller_months(t.order_items, t.orders, from_year=1998),
    f"""WITH {SALES}, best AS (
        SELECT l_suppkey FROM (SELECT l_suppkey, rank() OVER (ORDER BY revenue DESC) AS rnk FROM earned) WHERE rnk <= 3
    )
    SELECT l.l_suppkey AS seller_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS month_earnings
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN best ON l.l_suppkey = best.l_suppkey
    WHERE month(o_orderdate) >= 8 OR year(o_orderdate) >= 1998
    GROUP BY 1, 2""",
)


# Order status and early shipping.
STATUS = "status AS (SELECT o_orderstatus AS order_status, count(*) AS amount FROM orders GROUP BY 1)"
register(
    "orders_per_status", lambda t: status.orders_per_status(t.orders), f"WITH {STATUS} SELECT order_status, amount FROM status"
)
register(
    "delivered_share",
    lambda t: status.delivered_share(status.orders_per_status(t.orders), DELIVERED),
    f"""SELECT count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = '{DELIVERED}') AS delivered,
        CAST(count(*) FILTER (WHERE o_orderstatus = '{DELIVERED}') AS DOUBLE) / count(*) AS delivered_share FROM orders""",
)
register(
    "orders_without_delivered",
    lambda t: status.without_status(status.orders_per_status(t.orders), DELIVERED),
    f"WITH {STATUS} SELECT order_status, amount FROM status WHERE order_status <> '{DELIVERED}'",
)
AHEAD = f"""{ORDERS},
flagged AS (
    SELECT order_id, carrier AS order_delivered_carrier_date, estimated AS order_estimated_delivery_date,
           date_diff('day', carrier, estimated) > 2 AS two_days, date_diff('day', carrier, estimated) <= 2 AS critical
    FROM placed WHERE carrier IS NOT NULL AND estimated IS NOT NULL
)"""
register("ship_ahead_flag", lambda t: shipping.ship_ahead_flag(t.orders), f"WITH {AHEAD} SELECT * FROM flagged")
register(
    "ship_ahead_counts",
    lambda t: shipping.with_ship_label(shipping.ship_ahead_counts(shipping.ship_ahead_flag(t.orders))),
    f"""WITH {AHEAD}
    SELECT two_days, count(*) AS count,
           CASE WHEN two_days THEN '{shipping.SHIPPED_EARLY}' ELSE '{shipping.SHIPPED_LATE}' END AS label
    FROM flagged GROUP BY two_days""",
)


# Data checks and small operators.
def column_line(name: str, kind: str, distinct: bool) -> str:
    values = f"count(DISTINCT {name})" if distinct else "CAST(NULL AS BIGINT)"
    return (
        f"SELECT '{name}' AS \"column\", '{kind}' AS type, count(*) AS \"rows\", count(*) - count({name}) AS nulls, "
        f"{values} AS distinct_values FROM orders"
    )


register(
    "table_profile",
    lambda t: profile(t.raw("orders"), distinct=["o_orderkey", "o_custkey"]),
    " UNION ALL ".join(
        column_line(name, kind, name in ("o_orderkey", "o_custkey"))
        for name, kind in (
            ("o_orderkey", "bigint"),
            ("o_custkey", "bigint"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string"),
        )
    ),
)
register(
    "duplicate_groups",
    lambda t: duplicate_groups(t.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
register(
    "key_lookup",
    lambda t: look_up(t.customers, "customer_unique_id", "17"),
    "SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id FROM orders WHERE o_custkey = 17",
)
register(
    "distinct_ratio",
    lambda t: distinct_ratio(t.geolocation, ["geolocation_lat", "geolocation_lng"]),
    """WITH geo AS (SELECT DISTINCT c_acctbal, c_custkey % 3600 FROM customer)
    SELECT (SELECT count(*) FROM customer) AS "rows", count(*) AS distinct_rows,
           CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) AS ratio FROM geo""",
)
register(
    "sample_points",
    lambda t: sample_points(
        t.geolocation.withColumn("place", F.round(F.col("geolocation_lat") * 100).cast("long")),
        ["geolocation_lat", "geolocation_lng"], 0.1, key=["geolocation_zip_code_prefix", "place"], seed=7,
    ),
    """SELECT c_acctbal AS geolocation_lat, (c_custkey % 3600) / 10 - 180 AS geolocation_lng FROM customer
    WHERE CAST('0x' || substr(md5('7|' || (c_nationkey + 5) || '|' || CAST(round(c_acctbal * 100) AS BIGINT)), 1, 8) AS BIGINT)
          < CAST(floor(0.1 * 4294967296) AS BIGINT)""",
)


def fixed_points(t: StarTables) -> DataFrame:
    """300 positions for a map, customers drawn in proportion to their balance: merged from samples of two halves."""
    points = t.raw("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    halves = [points.where(F.col("c_custkey") % 2 == i) for i in range(2)]
    samples = [fixed_sample(half, 300, key=["c_custkey"], seed=3, weight="c_acctbal") for half in halves]
    return merge_samples(samples, 300, key=["c_custkey"]).drop("priority")


register(
    "fixed_points",
    fixed_points,
    """SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal > 0
    ORDER BY -ln((CAST(CAST('0x' || substr(md5('3|' || c_custkey), 1, 13) AS BIGINT) AS DOUBLE) + 1) / 4503599627370497.0)
             / c_acctbal, c_custkey LIMIT 300""",
)


def all_seller_ranks(t: StarTables, places: list[str]) -> DataFrame:
    """Every seller's place by revenue in tens of thousands, so that many share one."""
    sales = sellers.seller_sales(t.order_items, t.sellers)
    sales = sales.select("seller_id", *places, F.expr("earned div 100000000").alias("millions"))
    return complete_rank(sales, "millions", scratch_folder(t.spark, "ranks"), places)


def all_ranks_sql(place: str) -> str:
    over = f"OVER ({f'PARTITION BY {place}' if place else ''} ORDER BY millions DESC)"
    return f"""WITH {SALES}, told AS (SELECT *, CAST(floor(revenue / 1000000) AS BIGINT) AS millions FROM sales)
    SELECT seller_id, {f'{place}, ' if place else ''}millions, rank() {over} AS rank, dense_rank() {over} AS dense_rank,
           percent_rank() {over} AS percent_rank FROM told"""


register("all_seller_ranks", lambda t: all_seller_ranks(t, []), all_ranks_sql(""))
register("all_seller_ranks_state", lambda t: all_seller_ranks(t, ["seller_state"]), all_ranks_sql("seller_state"))


def customer_sets(t: StarTables) -> IdSets:
    return id_sets(t.customers, "customer_unique_id", "customer_id", scratch_folder(t.spark, "sets"))


def ids_of_month_winners(t: StarTables) -> DataFrame:
    """All ids of the persons who paid most in a month, from their sets."""
    paid = spenders.month_payments(t.orders, t.order_payments, year=YEAR, excluded_status=CANCELED)
    winners = spenders.month_spending_unique(paid, t.customers).select("customer_unique_id").distinct()
    return set_members(customer_sets(t), winners)


register(
    "ids_per_person",
    lambda t: set_sizes(customer_sets(t)),
    "SELECT o_custkey AS customer_unique_id, count(DISTINCT o_orderkey) AS size FROM orders GROUP BY 1",
)
register(
    "ids_of_month_winners",
    ids_of_month_winners,
    f"""SELECT DISTINCT customer_unique_id, CAST(customer_id AS BIGINT) AS customer_id
    FROM ({ENTRIES['month_spending_unique'][1]}) AS r""",
)


# The same questions in Spark SQL: views, a common table expression, IN, and EXTRACT.
def sql_top_products(t: StarTables) -> DataFrame:
    for name in ("order_items", "products", "category_translation"):
        getattr(t, name).createOrReplaceTempView(f"sales_{name}")
    return t.spark.sql(
        """
        WITH sold AS (
            SELECT product_category_name_english AS product_category_name, product_id, count(product_id) AS together
            FROM sales_order_items JOIN sales_products USING (product_id)
            JOIN sales_category_translation USING (product_category_name)
            GROUP BY ALL
        )
        SELECT product_category_name, product_id, together
        FROM (SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY together DESC, product_id) AS n
              FROM sold)
        WHERE n < 4 AND product_category_name IN (
            SELECT product_category_name FROM sold GROUP BY 1 ORDER BY sum(together) DESC, 1 LIMIT 10)
        """
    )


def sql_payments_by_month(t: StarTables) -> DataFrame:
    return t.spark.sql(
        """
        SELECT CAST(extract(year FROM order_purchase_timestamp) AS INT) AS year,
               CAST(extract(month FROM order_purchase_timestamp) AS INT) AS month,
               count(*) AS payments, CAST(sum(CAST(payment_value AS DECIMAL(18,2))) AS DOUBLE) AS paid
        FROM {payments} JOIN {orders} USING (order_id) GROUP BY 1, 2
        """,
        payments=t.order_payments,
        orders=t.orders,
    )


register(
    "sql_top_products",
    sql_top_products,
    f"SELECT product_category_name, product_id, together FROM ({ENTRIES['top_products_numbered'][1]}) AS r",
)
register(
    "sql_payments_by_month",
    sql_payments_by_month,
    f"WITH {PAYMENTS} SELECT year, month, count(*) AS payments, CAST(sum(payment) AS DOUBLE) AS paid FROM paid GROUP BY 1, 2",
)


def sql_state_bands(t: StarTables) -> DataFrame:
    """State totals with marker sizes and colours, in SQL with the library's functions and parameters."""
    register_sql_functions(t.spark)
    for name in ("order_items", "sellers", "geolocation"):
        getattr(t, name).createOrReplaceTempView(f"sales_{name}")
    return t.spark.sql(
        """
        WITH earned AS (
            SELECT seller_id, sum(tw_cents(price)) AS earned FROM sales_order_items WHERE seller_id IS NOT NULL GROUP BY seller_id
        ),
        zips AS (
            SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng
            FROM sales_geolocation GROUP BY 1
        ),
        by_zip AS (
            SELECT SELLER_STATE, seller_zip_code_prefix AS zip, sum(CAST(earned AS DECIMAL(38,0))) AS earned, count(seller_city) AS n
            FROM sales_sellers JOIN earned USING (seller_id) GROUP BY ALL
        ),
        totals AS (
            SELECT seller_state, CAST(sum(earned) AS DOUBLE) / 100 AS revenue, sum(n) AS count,
                   round(sum(lat * n) / sum(CASE WHEN lat IS NOT NULL THEN n END), 6) AS lat,
                   round(sum(lng * n) / sum(CASE WHEN lng IS NOT NULL THEN n END), 6) AS lng
            FROM by_zip LEFT JOIN zips USING (zip) GROUP BY seller_state
        )
        SELECT *, CAST(tw_pick(tw_band(count, :limits), :sizes) AS BIGINT) AS size, tw_pick(tw_band(count, :limits), :colors) AS colors
        FROM totals
        """,
        args={
            "limits": F.array(*(F.lit(float(x)) for x in COUNT_LIMITS)),
            "sizes": F.array(*(F.lit(str(x)) for x in sellers.SIZES)),
            "colors": F.array(*map(F.lit, sellers.COLORS)),
        },
    )


register("sql_state_bands", sql_state_bands, ENTRIES["state_bands"][1])


GRID = {"finest": 6, "y_bounds": (-1000.0, 10000.0)}


def cells_sql(level: int, finest: int) -> str:
    cells = 1 << finest

    def cell(value: str, low: float, high: float) -> str:
        at = f"floor(({value} - ({low})) / {(high - low) / cells!r})"
        return f"(CAST(least(greatest({at}, 0), {cells - 1}) AS BIGINT) >> {finest - level})"

    return f"""SELECT CAST({level} AS INTEGER) AS level, {cell("c_acctbal", -1000.0, 10000.0)} AS y,
        {cell("((c_custkey % 3600) / 10 - 180)", -180.0, 180.0)} AS x, count(*) AS points
        FROM customer WHERE c_acctbal IS NOT NULL GROUP BY ALL"""


register(
    "map_cells",
    lambda t: grid_pyramid(t.geolocation, "geolocation_lat", "geolocation_lng", **GRID),
    " UNION ALL ".join(cells_sql(i, GRID["finest"]) for i in range(GRID["finest"] + 1)),
)


def quantity_by_type(t: StarTables) -> DataFrame:
    per_part = t.raw("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("quantity"))
    parts = per_part.join(t.raw("part").select("p_partkey", "p_type", "p_brand"), "p_partkey")
    return sum_by(parts, "p_type", "quantity", dimensions=["p_type", "p_brand"], measures=["quantity"])


register(
    "sum_by_dimension",
    quantity_by_type,
    "SELECT p_type, sum(l_quantity) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type",
)
register(
    "first_rows",
    lambda t: first_rows(t.order_payments, 50, "order_id", "payment_value"),
    """SELECT l_orderkey AS order_id, l_extendedprice AS payment_value FROM lineitem
    ORDER BY l_orderkey, l_extendedprice LIMIT 50""",
)
register(
    "columns_by_position",
    lambda t: columns_at(t.raw("customer"), [0, 1, -1]),
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)


# Files.
def ingest_roundtrip(t: StarTables) -> DataFrame:
    """Orders as CSV text, ingested to gzip Parquet and read back."""
    folder = scratch_folder(t.spark, "ingest")
    orders = t.orders.withColumn("order_approved_at", F.lit(None))
    orders.select(*(F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(SCHEMAS["orders"]))).write.csv(
        f"{folder}/csv/orders", header=True, timestampFormat="yyyy-MM-dd HH:mm:ss"
    )
    ingest(t.spark, {"orders": f"{folder}/csv/orders"}, f"{folder}/parquet", compression="gzip")
    back = open_tables(t.spark, f"{folder}/parquet", ["orders"])["orders"]
    dates = [f.name for f in back.schema if f.dataType.typeName() == "timestamp"]
    return back.withColumns({c: as_date(back, c) for c in dates}).drop("order_approved_at")


register(
    "ingest_roundtrip",
    ingest_roundtrip,
    f"""WITH {ORDERS}
    SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
           purchased AS order_purchase_timestamp, carrier AS order_delivered_carrier_date,
           delivered AS order_delivered_customer_date, estimated AS order_estimated_delivery_date
    FROM placed""",
)


def as_input(t: StarTables, table: str) -> DataFrame:
    """A test table with the columns of `SCHEMAS`, those that it lacks being null."""
    df, schema = getattr(t, table), StructType.fromDDL(SCHEMAS[table])
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


# Tables with a test table of their kind, and their columns that it fills. Reviews have none.
FILLED = {
    "customers": ["customer_id", "customer_unique_id"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    "order_items": ["order_id", "product_id", "seller_id", "price"],
    "order_payments": ["order_id", "payment_value"],
    "orders": ["order_id", "customer_id", "order_status"],
    "products": ["product_id", "product_category_name"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}


REVIEWS = ["review_id", "order_id", "review_score", "review_comment_message"]


def ingest_everything(t: StarTables, folder: str) -> dict[str, TableCounts]:
    """All tables as CSV text, reviews with a line break in quotes, ingested together."""
    reviews = t.raw("orders").select(
        F.concat(F.lit("r"), F.col("o_orderkey")).alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_orderkey") % 5 + 1).alias("review_score"),
        F.concat(F.col("o_orderstatus"), F.lit("\nline 2, \"quoted\"")).alias("review_comment_message"),
    )
    stars = {table: as_input(t, table) for table in FILLED}
    schema = StructType.fromDDL(SCHEMAS["order_reviews"])
    stars["order_reviews"] = reviews.select(
        *((F.col(f.name) if f.name in reviews.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema)
    )
    for table, df in stars.items():
        df.write.option("escape", '"').csv(f"{folder}/csv/{table}", header=True, timestampFormat="yyyy-MM-dd HH:mm:ss")
    return ingest(t.spark, {x: f"{folder}/csv/{x}" for x in stars}, f"{folder}/parquet", multi_line=["order_reviews"], escape='"')


def ingest_all_tables(t: StarTables) -> DataFrame:
    """Rows and digest of each ingested table, read back."""
    folder = scratch_folder(t.spark, "ingest-all")
    ingest_everything(t, folder)
    return bundle.result_digests(t.spark, f"{folder}/parquet", {**FILLED, "order_reviews": REVIEWS})


# Columns of whole numbers and text, whose text forms are the same everywhere.
COUNTED = {
    "customers": ["customer_id", "customer_unique_id", "customer_city"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "order_items": ["order_id", "product_id", "seller_id", "order_item_id"],
    "orders": ["order_id", "order_status"],
    "products": ["product_id", "product_category_name"],
    "order_reviews": ["review_id", "review_score", "review_comment_title"],
}


def ingest_counts(t: StarTables) -> DataFrame:
    """Rows, nulls, least and largest value of some columns, taken while the tables are written."""
    return counts_table(t.spark, ingest_everything(t, scratch_folder(t.spark, "ingest-counts")), COUNTED)


def ingested_digest(table: str, source: str, values: list[str]) -> str:
    row = ", ".join(f"coalesce(CAST({v} AS VARCHAR), '')" for v in values)
    bits = f"CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 8) AS BIGINT)"
    return (
        f"SELECT '{table}' AS result, count(*) AS \"rows\", CAST(coalesce(sum({bits}), 0) AS BIGINT) AS digest FROM {source}"
    )


def hundredths(value: str) -> str:
    return f"CAST(floor({value} * 100 + 0.5) AS BIGINT)"


register(
    "ingest_all_tables",
    ingest_all_tables,
    " UNION ALL ".join(
        ingested_digest(*x)
        for x in (
            ("customers", "orders", ["o_orderkey", "o_custkey"]),
            ("geolocation", "customer", ["c_nationkey + 5", hundredths("c_acctbal"), hundredths("(c_custkey % 3600 / 10 - 180)")]),
            ("order_items", "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", hundredths("l_extendedprice")]),
            ("order_payments", "lineitem", ["l_orderkey", hundredths("l_extendedprice")]),
            ("orders", "orders", ["o_orderkey", "o_orderkey", "o_orderstatus"]),
            ("products", "part", ["p_partkey", "p_brand"]),
            (
                "sellers",
                "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
                ["s_suppkey", "s_nationkey", "n_name", "r_name"],
            ),
            ("category_translation", "range(1, 25) AS b(n)", ["'Brand#' || n", "'brand_' || lpad(CAST(n AS VARCHAR), 2, '0')"]),
            (
                "order_reviews",
                "orders",
                ["'r' || o_orderkey", "o_orderkey", "o_orderkey % 5 + 1", "o_orderstatus || chr(10) || 'line 2, \"quoted\"'"],
            ),
        )
    ),
)


def counts_line(table: str, column: str, value: str, kind: str, source: str) -> str:
    v = f"CAST({value} AS {kind})"
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", count(*) AS \"rows\", count(*) - count({v}) AS nulls, "
        f"CAST(min({v}) AS VARCHAR) AS least, CAST(max({v}) AS VARCHAR) AS largest FROM {source}"
    )


register(
    "ingest_counts",
    ingest_counts,
    " UNION ALL ".join(
        counts_line(*x)
        for x in (
            ("customers", "customer_id", "o_orderkey", "VARCHAR", "orders"),
            ("customers", "customer_unique_id", "o_custkey", "VARCHAR", "orders"),
            ("customers", "customer_city", "NULL", "VARCHAR", "orders"),
            ("geolocation", "geolocation_zip_code_prefix", "c_nationkey + 5", "BIGINT", "customer"),
            ("order_items", "order_id", "l_orderkey", "VARCHAR", "lineitem"),
            ("order_items", "product_id", "l_partkey", "VARCHAR", "lineitem"),
            ("order_items", "seller_id", "l_suppkey", "VARCHAR", "lineitem"),
            ("order_items", "order_item_id", "NULL", "BIGINT", "lineitem"),
            ("orders", "order_id", "o_orderkey", "VARCHAR", "orders"),
            ("orders", "order_status", "o_orderstatus", "VARCHAR", "orders"),
            ("products", "product_id", "p_partkey", "VARCHAR", "part"),
            ("products", "product_category_name", "p_brand", "VARCHAR", "part"),
            ("order_reviews", "review_id", "'r' || o_orderkey", "VARCHAR", "orders"),
            ("order_reviews", "review_score", "o_orderkey % 5 + 1", "BIGINT", "orders"),
            ("order_reviews", "review_comment_title", "NULL", "VARCHAR", "orders"),
        )
    ),
)


def ingest_quarantine(t: StarTables) -> DataFrame:
    """Payments as CSV text with planted damage; the rows set aside with their reasons, and the number of good ones."""
    folder = scratch_folder(t.spark, "damaged")
    lines = t.raw("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("payment_sequential"),
        F.lit("card").alias("payment_type"),
        F.when(F.col("l_orderkey") % 53 == 5, "many").otherwise("1").alias("payment_installments"),
        F.when(F.col("l_orderkey") % 97 == 0, F.concat(F.lit("x"), "l_linenumber")).otherwise("2.5").alias("payment_value"),
    )
    lines.write.csv(f"{folder}/csv", header=True)
    counts = ingest(t.spark, {"order_payments": f"{folder}/csv"}, f"{folder}/good", quarantine=f"{folder}/bad", most_damaged=0.2)
    rows = t.spark.range(1).select(F.lit("good rows").alias("record"), F.lit(str(counts["order_payments"].rows)).alias("reason"))
    return open_tables(t.spark, f"{folder}/bad", ["order_payments"])["order_payments"].select("record", "reason").union(rows)


register(
    "ingest_quarantine",
    ingest_quarantine,
    """WITH lines AS (
        SELECT l_orderkey % 53 = 5 AS many, l_orderkey % 97 = 0 AS priced, l_orderkey, l_linenumber FROM lineitem
    )
    SELECT l_orderkey || ',' || l_linenumber || ',card,' || CASE WHEN many THEN 'many' ELSE '1' END || ','
           || CASE WHEN priced THEN 'x' || l_linenumber ELSE '2.5' END AS record,
           concat_ws('; ', CASE WHEN many THEN 'payment_installments is no int: many' END,
                     CASE WHEN priced THEN 'payment_value is no double: x' || l_linenumber END) AS reason
    FROM lines WHERE many OR priced
    UNION ALL SELECT 'good rows', CAST(count(*) AS VARCHAR) FROM lines WHERE NOT many AND NOT priced""",
)


def bucketed(t: StarTables) -> OrderBuckets:
    """Orders and payments in buckets by order."""
    folder = scratch_folder(t.spark, "buckets")
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return write_order_buckets(t.spark, t.orders, {"order_payments": t.order_payments}, folder, buckets)


def bucketed_month_spending(t: StarTables) -> DataFrame:
    store = bucketed(t)
    return spenders.month_spending(
        spenders.month_payments(store.placed, store.facts("order_payments"), year=YEAR, excluded_status=CANCELED, keys=KEYS)
    )


def bucketed_max_payment(t: StarTables) -> DataFrame:
    store = bucketed(t)
    return spenders.max_payment_by_month(store.placed, store.facts("order_payments"), keys=KEYS)


register("bucketed_month_spending", bucketed_month_spending, ENTRIES["month_spending"][1])
register("bucketed_max_payment", bucketed_max_payment, ENTRIES["max_payment_by_month"][1])


def marked_csv(t: StarTables) -> DataFrame:
    """Products from CSV files whose headers begin with a byte order mark."""
    folder = scratch_folder(t.spark, "marked")
    products = t.products.select(F.col("product_id").cast("string").alias("\ufeffproduct_id"), "product_category_name")
    products.write.csv(folder, header=True)
    return read_csv(t.spark, folder, "product_id string, product_category_name string")


register(
    "byte_order_mark",
    marked_csv,
    "SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS product_category_name FROM part",
)


# Result tables: the query with the same rows, and the columns compared. Prices and positions count in hundredths.
BUNDLE = {
    bundle.DELAY_HISTOGRAM: ("delay_histogram", ["days_delayed", "no_orders"]),
    bundle.DELAY_STATISTICS: ("delay_summary", ["summary", "days_delayed"]),
    bundle.ORDER_STRUCTURE: ("order_structure", ["order_type", "count"]),
    bundle.ORDERS_PER_STATUS: ("orders_per_status", ["order_status", "amount"]),
    bundle.OTHER_STATUSES: ("orders_without_delivered", ["order_status", "amount"]),
    bundle.SHIP_AHEAD: ("ship_ahead_counts", ["two_days", "count"]),
    bundle.TOP_CATEGORIES: ("top_categories_rest", ["count", "product_category_name"]),
    bundle.TOP_PRODUCTS: ("top_products_per_category", ["product_category_name", "product_id", "together"]),
    bundle.TOP_PRODUCTS_NUMBERED: ("top_products_numbered", ["product_category_name", "product_id", "product_number"]),
    bundle.CATEGORIES: ("category_list", ["product_category_name"]),
    bundle.MONTH_SPENDING: ("month_spending", ["order_purchase_month", "customer_id", "month_payment"]),
    bundle.MONTH_SPENDING_UNIQUE: ("month_spending_unique", ["order_purchase_month", "customer_id", "month_payment"]),
    bundle.BEST_SELLERS_STATE: ("best_sellers_state_wide", ["seller_state", "1_best_seller", "2_best_seller"]),
    bundle.BEST_SELLERS_CITY: ("best_sellers_city_wide", ["seller_city", "1_best_seller", "2_best_seller"]),
    bundle.STATE_SALES: ("state_bands", ["seller_state", "revenue", "count", "lat", "lng", "size", "colors"]),
    bundle.CITY_SALES: ("city_bands", ["seller_city", "revenue", "count", "lat", "lng", "size", "colors"]),
    bundle.CITY_MAP: ("city_map_dataset", ["seller_city", "revenue", "size", "1_best_seller", "2_best_seller"]),
}
IN_HUNDREDTHS = {"month_payment", "revenue", "lat", "lng"}


def report_bundle(t: StarTables) -> DataFrame:
    """All result tables written for one input folder; returns their names, row counts and digests."""
    folder = scratch_folder(t.spark, "results")
    settings = bundle.Settings(year=YEAR, excluded_status=CANCELED, dominant_status=DELIVERED, count_limits=COUNT_LIMITS)
    written = bundle.write_reports(t.spark, t.tables(), folder, settings=settings)
    return bundle.result_digests(t.spark, folder, {name: BUNDLE[name][1] for name in written})


def digest_line(name: str) -> str:
    query, columns = BUNDLE[name]
    texts = (f"CAST(floor({c} * 100 + 0.5) AS BIGINT)" if c in IN_HUNDREDTHS else f'"{c}"' for c in columns)
    row = ", ".join(f"coalesce(CAST({x} AS VARCHAR), '')" for x in texts)
    bits = f"CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 8) AS BIGINT)"
    return (
        f"SELECT '{name}' AS result, count(*) AS \"rows\", CAST(coalesce(sum({bits}), 0) AS BIGINT) AS digest "
        f"FROM ({ENTRIES[query][1]}) AS r"
    )


register("report_bundle", report_bundle, " UNION ALL ".join(map(digest_line, BUNDLE)))


def split_by_days(t: StarTables, n: int = 3) -> list[dict[str, DataFrame]]:
    """The test tables in batches: orders by id, items and payments by other rules, so that many come before or after
    their order."""
    rules = {"orders": "order_id", "order_items": "order_id + product_id", "order_payments": "order_id + floor(payment_value)"}
    return [{name: getattr(t, name).where(F.expr(f"({rule}) % {n} = {i}")) for name, rule in rules.items()} for i in range(n)]


def incremental_bundle(t: StarTables) -> DataFrame:
    """All result tables from three batches, the second offered twice, the first two compacted."""
    store = ReportStore(t.spark, scratch_folder(t.spark, "store"))
    first, second, third = split_by_days(t)
    for name, batch in (("a", first), ("b", second), ("b", second)):
        store.add(name, batch)
    store.compact()
    store.add("c", third)
    settings = bundle.Settings(year=YEAR, excluded_status=CANCELED, dominant_status=DELIVERED, count_limits=COUNT_LIMITS)
    store.refresh(t.tables(), settings)
    return bundle.result_digests(t.spark, store.open, {name: BUNDLE[name][1] for name in store.published.tables()})


def incremental_seller_months(t: StarTables) -> DataFrame:
    store = ReportStore(t.spark, scratch_folder(t.spark, "store"))
    for i, batch in enumerate(split_by_days(t, 2)):
        store.add(str(i), batch)
    return store.top_seller_months(3, since="1996-01-01")


register("incremental_bundle", incremental_bundle, ENTRIES["report_bundle"][1])
register(
    "incremental_seller_months",
    incremental_seller_months,
    """WITH sold AS (
        SELECT l_suppkey AS seller_id, l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem
    ),
    best AS (
        SELECT seller_id FROM (SELECT seller_id, rank() OVER (ORDER BY sum(price) DESC) AS place FROM sold GROUP BY 1)
        WHERE place <= 3
    )
    SELECT seller_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(sum(price) AS DOUBLE) AS month_earnings
    FROM sold JOIN best USING (seller_id) JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1, 2""",
)


# The training-data operators, where they are installed.
TRAINING: set[str] = set()
try:
    import corpus_pipeline
    from tradewind.llm import queries as training
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tradewind.llm"):
        raise
else:
    ENTRIES.update({name: (run, training.ORACLES.get(name)) for name, run in training.QUERIES.items()})
    ENTRIES["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    TRAINING.update(training.QUERIES, ["pipeline"])


def entry(spark: SparkSession) -> DataFrame:
    """Top two sellers of every state."""
    return queries()["top_sellers_state"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql is not None}
