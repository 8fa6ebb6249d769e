"""The batch job: every result table for one set of input tables.

Each big table is read once per report family. Its compact summary is written to the scratch folder
and the result tables are computed from there, so an executor lost late costs little.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_date
from ..operators import by_shuffle, count_by, require_unique
from ..sources import materialize, read_parquet, remove_folder, side_by_side, table_path, write_table
from . import categories, delivery, sellers, shipping, spenders, status

Tables = Mapping[str, DataFrame]
Parts = dict[str, Callable[[], DataFrame]]
Results = dict[str, DataFrame]

# Names of the result tables.
DELAY_HISTOGRAM = "1_task_days_delayed"
DELAY_STATISTICS = "1_task_days_delayed_basic_statistics"
ORDER_STRUCTURE = "1_task_orders_structure"
TOP_CATEGORIES = "2_task_top_10_categories"
TOP_PRODUCTS = "2_task_top_3_products"
TOP_PRODUCTS_NUMBERED = "2_task_top_3_products_from_top_10_categories"
CATEGORIES = "2_task_product_category"
MONTH_SPENDING = "3_task_month_spending"
MONTH_SPENDING_UNIQUE = "3_task_month_spending_unique"
BEST_SELLERS_STATE = "4_task_city_best_sellers_state_df"
BEST_SELLERS_CITY = "4_task_city_best_sellers_df"
STATE_SALES = "4_task_salesstate_df"
CITY_SALES = "4_task_salescity_df"
ORDERS_PER_STATUS = "5_task_delivery_pipeline"
SHIP_AHEAD = "6_task_two_days"
CITY_MAP = "city_map"
OTHER_STATUSES = "statuses_without_dominant"


@dataclass(frozen=True)
class Settings:
    year: int | None = None
    excluded_status: str = "canceled"
    dominant_status: str = "delivered"
    count_limits: Sequence[float] = sellers.COUNT_LIMITS
    compression: str = "zstd"


def order_summary(orders: DataFrame) -> DataFrame:
    """Orders per status, delay in days and early-shipping flag: one pass for three reports."""
    ahead = shipping.shipped_ahead(
        as_date(orders, "order_delivered_carrier_date"), as_date(orders, "order_estimated_delivery_date")
    )
    facts = orders.select(
        "order_status",
        as_date(orders, "order_delivered_customer_date").isNull().alias("undelivered"),
        delivery.days_late(orders).alias("days_late"),
        F.when(F.col("order_id").isNotNull(), ahead).alias("two_days"),
    )
    return count_by(facts, *facts.columns, name="no_orders")


# Each family: the summary tables that hold all its reports need, and the results from those. A summary is a function
# without arguments, so that none is planned that isn't asked for.


def order_parts(tables: Tables, settings: Settings) -> Parts:
    return {"order_summary": lambda: order_summary(tables["orders"])}


def order_results(parts: Tables, tables: Tables, settings: Settings) -> Results:
    summary = parts["order_summary"]
    profile = count_by(summary, "undelivered", "days_late", name="no_orders", weight="no_orders")
    return {
        DELAY_HISTOGRAM: delivery.delay_histogram(profile),
        DELAY_STATISTICS: delivery.delay_summary(profile),
        ORDER_STRUCTURE: delivery.order_structure(profile),
        ORDERS_PER_STATUS: status.orders_per_status(summary, weight="no_orders"),
        SHIP_AHEAD: shipping.ship_ahead_counts(summary, weight="no_orders"),
        OTHER_STATUSES: status.without_status(status.orders_per_status(summary, weight="no_orders"), settings.dominant_status),
    }


def category_parts(tables: Tables, settings: Settings) -> Parts:
    sold = lambda: categories.sold_products(tables["order_items"], tables["products"], tables["category_translation"])
    return {"sold_products": sold}


def category_results(parts: Tables, tables: Tables, settings: Settings) -> Results:
    sold = parts["sold_products"]
    return {
        TOP_CATEGORIES: categories.top_categories_rest(sold),
        TOP_PRODUCTS: categories.top_products(sold),
        TOP_PRODUCTS_NUMBERED: categories.top_products_numbered(sold),
        CATEGORIES: categories.category_list(sold),
    }


def spender_parts(tables: Tables, settings: Settings) -> Parts:
    paid = lambda: spenders.month_payments(
        tables["orders"], tables["order_payments"], year=settings.year, excluded_status=settings.excluded_status
    )
    return {"month_payments": paid}


def spender_results(parts: Tables, tables: Tables, settings: Settings) -> Results:
    paid = parts["month_payments"]
    return {
        MONTH_SPENDING: spenders.month_spending(paid),
        MONTH_SPENDING_UNIQUE: spenders.month_spending_unique(by_shuffle(paid), tables["customers"]),
    }


def seller_parts(tables: Tables, settings: Settings) -> Parts:
    return {
        "seller_sales": lambda: sellers.seller_sales(
            tables["order_items"], require_unique(tables["sellers"], "seller_id")
        ),
        "zip_positions": lambda: sellers.zip_positions(tables["geolocation"]),
    }


def seller_results(parts: Tables, tables: Tables, settings: Settings) -> Results:
    sales, positions = parts["seller_sales"], parts["zip_positions"]
    best = {place: sellers.best_sellers_wide(sales, place) for place in ("seller_state", "seller_city")}
    cities = sellers.with_count_bands(sellers.city_totals(sales, positions), settings.count_limits)
    return {
        BEST_SELLERS_STATE: best["seller_state"],
        BEST_SELLERS_CITY: best["seller_city"],
        STATE_SALES: sellers.with_count_bands(sellers.state_totals(sales, positions), settings.count_limits),
        CITY_SALES: cities,
        CITY_MAP: sellers.map_dataset(cities, best["seller_city"]),
    }


class Family(NamedTuple):
    parts: Callable[[Tables, Settings], Parts]
    results: Callable[[Tables, Tables, Settings], Results]


FAMILIES = {
    "orders": Family(order_parts, order_results),
    "categories": Family(category_parts, category_results),
    "spenders": Family(spender_parts, spender_results),
    "sellers": Family(seller_parts, seller_results),
}
NEEDED_TABLES = {
    "orders": ("orders",),
    "categories": ("order_items", "products", "category_translation"),
    "spenders": ("orders", "order_payments", "customers"),
    "sellers": ("order_items", "sellers", "geolocation"),
}


def needed_tables(families: Sequence[str]) -> list[str]:
    """The input tables that some report families read."""
    return sorted({table for family in families for table in NEEDED_TABLES[family]})


def write_results(
    spark: SparkSession, parts: Tables, tables: Tables, folder: str, families: Sequence[str], settings: Settings
) -> list[str]:
    """Write the result tables of some families from their summary tables, a few at a time; returns their names."""
    results = {}
    for family in families:
        results.update(FAMILIES[family].results(parts, tables, settings))
    side_by_side(
        spark,
        [partial(write_table, df, table_path(folder, name), compression=settings.compression) for name, df in results.items()],
    )
    return list(results)


def write_from(
    spark: SparkSession, parts: Parts, tables: Tables, folder: str, *, families: Sequence[str] = tuple(FAMILIES),
    settings: Settings = Settings(), scratch: str | None = None,
) -> list[str]:
    """Write the summary tables, side by side, then the results from those, side by side; returns the results' names.

    Summary tables go to ``scratch``, by default a folder beside the results, and are removed at the end.
    """
    scratch = f"{scratch or folder}/_scratch-{uuid.uuid4().hex}".replace("//_", "/_")
    jobs = [lambda name=name, part=part: materialize(part(), scratch, name) for name, part in parts.items()]
    try:
        kept = dict(zip(parts, side_by_side(spark, jobs)))
        return write_results(spark, kept, tables, folder, families, settings)
    finally:
        remove_folder(spark, scratch)


def write_reports(
    spark: SparkSession, tables: Tables, folder: str, *, families: Sequence[str] = tuple(FAMILIES),
    settings: Settings = Settings(), scratch: str | None = None,
) -> list[str]:
    """Write the result tables of some report families; returns their names."""
    parts: Parts = {}
    for family in families:
        parts.update(FAMILIES[family].parts(tables, settings))
    return write_from(spark, parts, tables, folder, families=families, settings=settings, scratch=scratch)


def result_digests(
    spark: SparkSession, folder: str | Callable[[str], DataFrame], columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """``result, rows, digest`` of result tables, written to a folder or opened by name: the sum over the rows of 32 bits of the md5 of their columns.

    Columns are joined as text by ``|``, null as nothing, doubles in whole hundredths.
    """

    def text(df: DataFrame, name: str):
        value = F.col(f"`{name}`")
        if df.schema[name].dataType.typeName() == "double":
            value = F.floor(value * 100 + 0.5).cast("long")
        return F.coalesce(value.cast("string"), F.lit(""))

    found = []
    for name, chosen in columns.items():
        df = folder(name) if callable(folder) else read_parquet(spark, table_path(folder, name))
        bits = F.conv(F.substring(F.md5(F.concat_ws("|", *(text(df, c) for c in chosen))), 1, 8), 16, 10).cast("long")
        totals = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).alias("digest"))
        found.append(totals.withColumn("result", F.lit(name)))
    return reduce(DataFrame.unionByName, found).select("result", "rows", "digest")


def report_map(spark: SparkSession, folder: str) -> DataFrame:
    """City map dataset from the written result tables."""
    return sellers.map_dataset(
        read_parquet(spark, table_path(folder, CITY_SALES)), read_parquet(spark, table_path(folder, BEST_SELLERS_CITY))
    )


def report_statuses(spark: SparkSession, folder: str, dominant: str = "delivered") -> DataFrame:
    """Orders per status without the dominant one, from the written result table."""
    return status.without_status(read_parquet(spark, table_path(folder, ORDERS_PER_STATUS)), dominant)
