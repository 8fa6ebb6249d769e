import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.functions import (
    cents,
    as_date,
    band,
    in_year,
    merge_cents,
    month_label,
    month_start,
    on_or_after,
    pick,
    sum_cents,
    to_amount,
    year_before_last,
)
from tradewind.plans.sellers import COLORS, COUNT_LIMITS, REVENUE_LIMITS, SIZES

# Seller count -> marker radius and colour, from a published map of 23 states.
MARKERS = [
    (1, 1, "#66CF83"), (1, 1, "#66CF83"), (1, 1, "#66CF83"), (2, 1, "#66CF83"), (1, 1, "#66CF83"), (2, 1, "#66CF83"),
    (5, 1, "#66CF83"), (5, 1, "#66CF83"), (4, 1, "#66CF83"), (6, 1, "#66CF83"), (13, 3, "#43A85F"), (1, 1, "#66CF83"),
    (23, 5, "#C3E839"), (40, 5, "#C3E839"), (9, 1, "#66CF83"), (30, 5, "#C3E839"), (19, 3, "#43A85F"),
    (129, 8, "#D5B421"), (190, 8, "#D5B421"), (171, 8, "#D5B421"), (244, 12, "#D58321"), (349, 12, "#D58321"),
    (1849, 25, "#CE4C18"),
]


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_markers(spark):
    df = spark.createDataFrame(MARKERS, "count long, radius int, colour string")
    number = band(F.col("count"), COUNT_LIMITS)
    assert df.filter((pick(number, SIZES) != F.col("radius")) | (pick(number, COLORS) != F.col("colour"))).count() == 0
    assert sum(m[0] for m in MARKERS) == 3095


@pytest.mark.parametrize(
    ("limits", "cases"),
    [
        (COUNT_LIMITS, {1501: 0, 1500: 1, 201: 1, 200: 2, 101: 2, 100: 3, 21: 3, 20: 4, 11: 4, 10: 5, 0: 5, None: None}),
        (REVENUE_LIMITS, {8_000_001: 0, 8_000_000: 1, 1_000_000: 2, 500_000: 3, 50_000: 4, 10_000: 5, -1: 5}),
    ],
)
def test_band_edges(spark, limits, cases):
    df = spark.createDataFrame(list(cases.items()), "value long, expected int")
    assert column(df, band(F.col("value"), limits)) == list(cases.values())


def test_as_date_takes_text_timestamps_and_dates(spark):
    text = spark.createDataFrame([("2017-10-02 23:59:59",), (None,)], "t string")
    day = dt.date(2017, 10, 2)
    assert column(text, as_date(text, "t")) == [day, None]
    for wrong in ("soon", "03/01/2017 10:00", ""):
        damaged = spark.createDataFrame([(wrong,)], "t string")
        with pytest.raises(Exception, match="holds no time"):
            column(damaged, as_date(damaged, "t"))
    typed = text.filter("t like '2017%'").select(F.col("t").cast("timestamp").alias("t"))
    assert column(typed, as_date(typed, "t")) == [day]
    dates = typed.select(F.to_date("t").alias("t"))
    assert column(dates, as_date(dates, "t")) == [day]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_in_year(spark, kind):
    times = ["2016-12-31 23:59:59", "2017-01-01 00:00:00", "2017-12-31 23:59:59", "2018-01-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    if kind != "string":
        df = df.select(F.col("t").cast(kind).alias("t"))
    assert df.filter(in_year(df, "t", 2017)).count() == 2
    assert df.filter(in_year(df, "t", year_before_last(df, "t"))).count() == 2
    assert df.filter(on_or_after(df, "t", "2017-12-31")).count() == 2


def test_months(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    assert column(df, month_label(F.col("m"))) == "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    assert column(df.limit(1), month_start(F.lit(dt.date(2017, 8, 31)))) == [dt.date(2017, 8, 1)]


def test_cents_are_exact_in_any_order(spark):
    random.seed(3)
    prices = [random.randint(-10**9, 10**9) / 100 for _ in range(5000)]
    df = spark.createDataFrame([(p,) for p in prices], "price double").repartition(7)
    exact = sum(Decimal(str(p)) for p in prices)
    assert df.agg(to_amount(sum_cents("price"))).first()[0] == float(exact)
    parts = df.groupBy((F.col("price") > 0).alias("g")).agg(sum_cents("price").alias("c"))
    assert parts.agg(to_amount(merge_cents("c"))).first()[0] == float(exact)


def test_merged_cents_do_not_overflow(spark):
    df = spark.range(3).select(F.lit(2**62).alias("c"))
    assert df.agg(merge_cents("c")).first()[0] == 3 * 2**62


def test_prices_are_whole_cents_or_fail(spark):
    good = spark.createDataFrame([(10.0,), (0.07,), (-1.15,), (None,), (123456789012.34,)], "p double")
    assert column(good, cents("p")) == [1000, 7, -115, None, 12345678901234]
    for wrong in (float("nan"), 1e30, 0.004, float("inf"), 1.005):
        odd = spark.createDataFrame([(wrong,)], "p double")
        with pytest.raises(Exception, match="no price in whole cents"):
            column(odd, cents("p"))
