"""Best-selling categories and products.

``sold_products`` counts items per product before any join, so a product that makes up much of the
items is one row by the time products and category names are joined. The other results read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import percent
from ..operators import top_rows, top_with_rest

CATEGORY = "product_category_name"


def translated_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """``product_id`` with its English category; products without a translated category are left out."""
    return products.join(translation, CATEGORY).select("product_id", F.col(f"{CATEGORY}_english").alias(CATEGORY))


def items_per_product(order_items: DataFrame) -> DataFrame:
    """``product_id, items``: number of items sold, known product or not."""
    return order_items.groupBy("product_id").agg(F.count(F.lit(1)).alias("items"))


def with_category(sold: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """``product_category_name, product_id, together`` for the counts of ``items_per_product``."""
    return (
        sold.join(translated_products(products, translation), "product_id")
        .groupBy(CATEGORY, "product_id")
        .agg(F.sum("items").alias("together"))
    )


def sold_products(order_items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """``product_category_name, product_id, together``: number of items sold per product."""
    return with_category(items_per_product(order_items), products, translation)


def items_per_category(sold: DataFrame) -> DataFrame:
    return sold.groupBy(CATEGORY).agg(F.sum("together").alias("count"))


def top_categories(sold: DataFrame, n: int = 10) -> DataFrame:
    """The n best-selling categories; equal counts in name order."""
    return items_per_category(sold).orderBy(F.desc("count"), CATEGORY).limit(n)


def top_categories_rest(sold: DataFrame, n: int = 10) -> DataFrame:
    """``count, product_category_name`` of the n best-selling categories, and a last row "rest"."""
    return top_with_rest(items_per_category(sold), CATEGORY, "count", n)


def _top_products(sold: DataFrame, n: int) -> DataFrame:
    return top_rows(sold, [CATEGORY], "together", n, tie_break=["product_id"])


def top_products(sold: DataFrame, n: int = 3) -> DataFrame:
    """``product_category_name, product_id, together``: the n most sold products of each category."""
    return _top_products(sold, n).select(CATEGORY, "product_id", "together")


def top_products_numbered(sold: DataFrame, n: int = 3, categories: int = 10) -> DataFrame:
    """The same for the best-selling categories only, with ``product_number`` as text."""
    best = top_categories(sold, categories).select(CATEGORY)
    return (
        _top_products(sold, n)
        .join(best, CATEGORY, "left_semi")
        .select(CATEGORY, "product_id", "together", F.col("position").cast("string").alias("product_number"))
    )


def category_list(sold: DataFrame) -> DataFrame:
    return sold.select(CATEGORY).distinct()


def category_count(sold: DataFrame, n: int = 10) -> DataFrame:
    """One row: number of categories sold, and how many of them the top n hold."""
    counts = items_per_category(sold).agg(F.count(CATEGORY).alias("no_categories"))
    return counts.withColumn("no_top_categories", F.least("no_categories", F.lit(n).cast("long")))


def category_share(sold: DataFrame, n: int = 10) -> DataFrame:
    """One row: all items, items in the top n categories, and their percentage."""
    in_top = top_categories(sold, n).agg(F.sum("count")).scalar()
    return (
        items_per_category(sold)
        .agg(F.sum("count").alias("items"))
        .select("items", in_top.alias("top_items"))
        .withColumn("top_percent", percent(F.col("top_items"), F.col("items")))
    )
