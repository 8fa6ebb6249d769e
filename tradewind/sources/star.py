"""The input tables of the reports, derived from a star schema of orders, line items, parts and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_parquet

# The estimate is this many days after the purchase; status F plays "delivered", P "canceled".
ESTIMATED_DAYS = 60
DELIVERED, CANCELED = "F", "P"
# Brands 1 ... 24 have a translated name; the 25th has none.
TRANSLATED_BRANDS = 24
# Zip codes from 0 on that sellers have and positions don't.
UNKNOWN_ZIP_CODES = 5


class StarTables:
    """Lazy input tables over one folder of star-schema Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        # Types as written, looked up once per table, since each look-up is a job.
        self.schemas = {}

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self.schemas:
            self.schemas[name] = read_parquet(self.spark, path).schema
        return read_parquet(self.spark, path, self.schemas[name])

    @property
    def orders(self) -> DataFrame:
        """One row per order; plans that use no ship date lose the join, since it cannot change the rows."""
        shipped = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(
                F.min("l_shipdate").alias("order_delivered_carrier_date"),
                F.max("l_shipdate").alias("order_delivered_customer_date"),
            )
        )
        placed = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.date_add("o_orderdate", ESTIMATED_DAYS).alias("order_estimated_delivery_date"),
        )
        return placed.join(shipped, "order_id", "left")

    @property
    def customers(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("customer_id"), F.col("o_custkey").alias("customer_unique_id")
        )

    @property
    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
        )

    @property
    def order_payments(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("payment_value")
        )

    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_category_name")
        )

    @property
    def category_translation(self) -> DataFrame:
        number = F.col("id").cast("string")
        return self.spark.range(1, TRANSLATED_BRANDS + 1, numPartitions=1).select(
            F.concat(F.lit("Brand#"), number).alias("product_category_name"),
            F.concat(F.lit("brand_"), F.lpad(number, 2, "0")).alias("product_category_name_english"),
        )

    @property
    def sellers(self) -> DataFrame:
        nation = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return (
            self.raw("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.col("n_name").alias("seller_city"),
                F.col("r_name").alias("seller_state"),
            )
        )

    @property
    def geolocation(self) -> DataFrame:
        """Positions of all customers; the first zip codes of sellers have none."""
        return self.raw("customer").select(
            (F.col("c_nationkey") + UNKNOWN_ZIP_CODES).alias("geolocation_zip_code_prefix"),
            F.col("c_acctbal").alias("geolocation_lat"),
            (F.col("c_custkey") % 3600 / 10 - 180).alias("geolocation_lng"),
        )

    def tables(self) -> dict[str, DataFrame]:
        names = (
            "orders", "customers", "order_items", "order_payments", "products", "category_translation", "sellers",
            "geolocation",
        )
        return {name: getattr(self, name) for name in names}
