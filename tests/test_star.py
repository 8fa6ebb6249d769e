"""The input tables do not depend on how the star schema was written."""

import pytest
from testdata import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as registry

SOURCE = str(TESTDATA / "sf0.001")
TABLES = ("orders", "lineitem", "part", "supplier", "nation", "region", "customer")
QUERIES = (
    "delay_stats", "max_payment_one_year", "month_spending_unique", "top_seller_months", "ship_ahead_counts", "city_totals",
    "top_categories_rest",
)


@pytest.mark.parametrize("kind", ["timestamp", "date"])
def test_other_types_and_many_files(spark, tmp_path, kind):
    for table in TABLES:
        df = spark.read.parquet(f"{SOURCE}/{table}.parquet")
        for name, stored in df.dtypes:
            if stored == "timestamp_ntz":
                df = df.withColumn(name, F.col(name).cast(kind))
            elif stored == "int":
                df = df.withColumn(name, F.col(name).cast("bigint"))
            elif name == "l_extendedprice" and kind == "date":
                df = df.withColumn(name, F.col(name).cast("decimal(12,2)"))
        df.repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    for name in QUERIES:
        found, wanted = (registry.queries()[name](spark, folder) for folder in (str(tmp_path), SOURCE))
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str), name
