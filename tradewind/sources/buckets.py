"""Orders and their facts stored so that they join without a shuffle.

Orders, items and payments are bucketed and sorted by order id and a sub-bucket. An order with very many facts would make its
bucket one long task, so its facts are dealt to sub-buckets, which hash to buckets of their own, and its row in the orders
stands once in each of these. Sums by (order, sub-bucket) and their join with orders need no exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .snapshots import Snapshots

SUB = "sub_bucket"
# Parts that a bucket's even share of rows has; parts meet in buckets by hash, so many small ones spread more evenly.
PARTS = 16
KEYS = ("order_id", SUB)


class OrderBuckets:
    """Bucketed tables below one folder, known to this session's catalog under names of their own.

    ``orders`` has each order once; ``placed`` has it once per sub-bucket, for joins with facts on ``KEYS``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._names: dict[str, str] = {}
        state = Snapshots(spark, f"{self.folder}/layout").latest()[1]
        for table, columns in state.get("tables", {}).items():
            self._names[table] = name = f"{table}_{uuid.uuid4().hex}"
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({', '.join(KEYS)}) "
                f"INTO {int(state['buckets'])} BUCKETS LOCATION '{self.folder}/{table}-{state['id']}'"
            )

    def facts(self, table: str) -> DataFrame:
        return self.spark.table(self._names[table])

    @property
    def placed(self) -> DataFrame:
        return self.facts("orders")

    @property
    def orders(self) -> DataFrame:
        return self.placed.filter(F.col(SUB) == 0).drop(SUB)

    def forget(self) -> None:
        """Take the tables out of the catalog; the files stay."""
        for name in self._names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._names = {}


def hot_orders(facts: Mapping[str, DataFrame], buckets: int) -> DataFrame:
    """``order_id, parts`` of orders with more than half a bucket's share of some table's rows: at most two a bucket and
    table. A part is a small share of a bucket."""
    found = []
    for df in facts.values():
        counts = df.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        share = counts.agg((F.sum("n") / buckets).alias("share")).scalar()
        parts = F.ceil(PARTS * F.col("n") / share).cast("int").alias("parts")
        found.append(counts.filter(2 * F.col("n") > share).select("order_id", parts))
    return reduce(DataFrame.unionByName, found).groupBy("order_id").agg(F.max("parts").alias("parts"))


def write_order_buckets(
    spark: SparkSession, orders: DataFrame, facts: Mapping[str, DataFrame], folder: str, buckets: int, compression: str = "zstd"
) -> OrderBuckets:
    """Store orders and tables with an ``order_id`` in ``buckets`` buckets, one file each, and open them. Facts without an
    order id are spread by row. A table that is there already is replaced for those who open it later."""
    home, run = folder.rstrip("/"), uuid.uuid4().hex
    layout = Snapshots(spark, f"{home}/layout")
    number = layout.latest()[0]
    hot = F.broadcast(hot_orders(facts, buckets))  # at most two a bucket and table
    # Rows of a task take turns, so that equal rows are dealt too.
    turn = F.monotonically_increasing_id()

    def dealt(df: DataFrame) -> DataFrame:
        parts = F.when(F.col("order_id").isNull(), PARTS * buckets).otherwise(F.coalesce("parts", F.lit(1)))
        return df.join(hot, "order_id", "left").withColumn(SUB, F.pmod(turn, parts).cast("int")).drop("parts")

    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias(SUB)
    frames = {"orders": orders.join(hot, "order_id", "left").select(*orders.columns, every)}
    frames |= {name: dealt(df) for name, df in facts.items()}
    columns = {}
    for table, df in frames.items():
        name = f"{table}_{uuid.uuid4().hex}"
        writer = df.repartition(buckets, *KEYS).write.bucketBy(buckets, *KEYS).sortBy(*KEYS).option("compression", compression)
        writer.option("path", f"{home}/{table}-{run}").format("parquet").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # of the catalog; it is opened by its layout
        columns[table] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    layout.commit(number, {"buckets": buckets, "tables": columns, "id": run})
    return OrderBuckets(spark, folder)
