import datetime as dt
from types import SimpleNamespace

import pytest
from plans import executed_plan
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.plans.spenders import month_payments
from tradewind.sources import (
    SCHEMAS,
    columns_at,
    first_rows,
    ingest,
    materialize,
    open_csv_tables,
    open_tables,
    read_csv,
    read_parquet,
    scratch_folder,
    table_path,
    write_table,
)

BOM = b"\xef\xbb\xbf"
TRANSLATION = "product_category_name,product_category_name_english\nbeleza_saude,health_beauty\nautomotivo,auto\n"
ORDERS = (
    "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
    "order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
    "o2,c2,shipped,2018-01-02 10:56:33,,,,2018-01-18 00:00:00\n"
)


def save(path, text, bom=False):
    path.write_bytes((BOM if bom else b"") + text.encode())
    return str(path)


def test_byte_order_mark_is_dropped(spark, tmp_path):
    path = save(tmp_path / "t.csv", TRANSLATION, bom=True)
    for df in (read_csv(spark, path), read_csv(spark, path, SCHEMAS["category_translation"])):
        assert df.columns == ["product_category_name", "product_category_name_english"]
        rows = [tuple(r) for r in df.collect()]
        assert rows == [("beleza_saude", "health_beauty"), ("automotivo", "auto")]


def test_types_given_and_inferred(spark, tmp_path):
    path = save(tmp_path / "orders.csv", ORDERS)
    given = read_csv(spark, path, SCHEMAS["orders"])
    assert given.schema == StructType.fromDDL(SCHEMAS["orders"])
    assert dict(read_csv(spark, path).dtypes)["order_purchase_timestamp"] == "timestamp"
    second = given.filter("order_id = 'o2'").first()
    assert second.order_purchase_timestamp == dt.datetime(2018, 1, 2, 10, 56, 33)
    assert second.order_delivered_customer_date is None


def test_reordered_file_fails(spark, tmp_path):
    path = save(tmp_path / "t.csv", "product_category_name_english,product_category_name\nauto,automotivo\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, SCHEMAS["category_translation"]).collect()


def test_line_breaks_in_quotes(spark, tmp_path):
    path = save(tmp_path / "r.csv", 'review_id,text\nr1,"first\nsecond, third"\nr2,x\n')
    assert [tuple(r) for r in read_csv(spark, path, "review_id string, text string", multi_line=True).collect()] == [
        ("r1", "first\nsecond, third"), ("r2", "x")
    ]


@pytest.mark.parametrize(("codec", "ending"), [("gzip", "gz"), ("zstd", "zstd"), ("snappy", "snappy")])
def test_ingest(spark, tmp_path, codec, ending):
    paths = {
        "orders": save(tmp_path / "o.csv", ORDERS),
        "category_translation": save(tmp_path / "t.csv", TRANSLATION, bom=True),
    }
    out = str(tmp_path / "parquet")
    for _ in range(2):  # the second run replaces the first
        ingest(spark, paths, out, compression=codec)
    files = [file.name for file in (tmp_path / "parquet/orders.parquet").glob("*.parquet")]
    assert files and all(f".{ending}.parquet" in name for name in files)
    tables, csv = open_tables(spark, out, list(paths)), open_csv_tables(spark, paths)
    for name in paths:
        assert tables[name].dtypes == csv[name].dtypes
        assert sorted(map(tuple, tables[name].collect()), key=str) == sorted(map(tuple, csv[name].collect()), key=str)


def test_ingest_all_nine_tables(spark, tmp_path):
    paths = {}
    for name, ddl in SCHEMAS.items():
        columns = StructType.fromDDL(ddl).names
        paths[name] = save(tmp_path / f"{name}.csv", ",".join(columns) + "\n" + "," * (len(columns) - 1) + "\n")
    ingest(spark, paths, str(tmp_path / "out"))
    assert {n: df.dtypes for n, df in open_tables(spark, str(tmp_path / "out")).items()} == {
        n: [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl)] for n, ddl in SCHEMAS.items()
    }


def test_ingest_by_year_prunes_folders(spark, tmp_path):
    ingest(spark, {"orders": save(tmp_path / "o.csv", ORDERS)}, str(tmp_path / "p"), orders_by_year=True)
    orders = read_parquet(spark, table_path(str(tmp_path / "p"), "orders"))
    assert [r.order_id for r in orders.filter("order_purchase_year = 2018").collect()] == ["o2"]
    assert sorted(p.name for p in (tmp_path / "p/orders.parquet").glob("order*")) == [
        "order_purchase_year=2017", "order_purchase_year=2018"
    ]


@pytest.mark.parametrize("year", [2018, None])
def test_year_reports_read_the_folders_of_that_year_only(spark, tmp_path, year):
    orders = ORDERS + "o3,c3,shipped,2012-01-02 10:56:33,,,,2012-01-18 00:00:00\n"
    orders += "o4,c4,shipped,2019-01-02 10:56:33,,,,2019-01-18 00:00:00\n"
    ingest(spark, {"orders": save(tmp_path / "o.csv", orders)}, str(tmp_path / "p"), orders_by_year=True)
    table = read_parquet(spark, table_path(str(tmp_path / "p"), "orders"))
    payments = spark.createDataFrame([(f"o{i}", 1.0 * i) for i in range(1, 5)], "order_id string, payment_value double")
    paid = month_payments(table, payments, year=year)
    assert [tuple(r) for r in paid.collect()] == [(1, "c2", 200)]
    scan = next(line for line in executed_plan(paid).split("\n") if "orders.parquet" in line and "order_status" in line)
    assert "order_purchase_year" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_ingest_rejects_unknown_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown"):
        ingest(spark, {"order": "x.csv"}, str(tmp_path))


def test_columns_and_rows(spark):
    df = spark.range(5).select("id", (F.col("id") * 2).alias("b"), (-F.col("id")).alias("c"))
    assert columns_at(df, [0, -1]).columns == ["id", "c"]
    assert [r.c for r in first_rows(df, 2, "c").collect()] == [-4, -3]
    assert first_rows(df, 3).count() == 3


def test_scratch(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    folder = scratch_folder(spark, "x")
    assert folder.startswith(base) and folder != scratch_folder(spark, "x")
    kept = materialize(spark.range(3), folder, "numbers")
    assert kept.count() == 3
    write_table(spark.range(1), f"{folder}/numbers")
    assert read_parquet(spark, f"{folder}/numbers").count() == 1


def test_scratch_without_a_checkpoint_folder():
    unset = SimpleNamespace(conf={"spark.sql.warehouse.dir": "/shared/tables"})
    assert scratch_folder(unset, "x").startswith("/shared/tables/x-")


@pytest.mark.parametrize("row", ["o1,c1,paid,soon,,,,", "o1,c1"])
def test_damaged_rows_fail(spark, tmp_path, row):
    names = [f.split()[0] for f in SCHEMAS["orders"].split(",")]
    (tmp_path / "orders.csv").write_text(",".join(names) + "\n" + row + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_csv(spark, str(tmp_path / "orders.csv"), SCHEMAS["orders"]).collect()
    assert read_csv(spark, str(tmp_path / "orders.csv"), SCHEMAS["orders"], mode="PERMISSIVE").count() == 1


def test_csv_reports_take_line_breaks(spark, tmp_path):
    names = [f.split()[0] for f in SCHEMAS["customers"].split(",")]
    (tmp_path / "c.csv").write_text(",".join(names) + "\nc1,u1,1,\"two\nlines\",X\n")
    tables = open_csv_tables(spark, {"customers": str(tmp_path / "c.csv")}, multi_line=["customers"])
    assert tables["customers"].count() == 1
