"""Whole and exact results when one key holds a third of the rows, against brute force in pandas."""

import datetime as dt
import random

import pandas as pd
import pytest

from tradewind.plans import categories, sellers, spenders


@pytest.fixture(scope="module")
def frames():
    rng = random.Random(11)

    def skewed(prefix, n):
        return f"{prefix}0" if rng.random() < 1 / 3 else f"{prefix}{rng.randint(0, n)}"

    items = pd.DataFrame(
        [(skewed("o", 400), skewed("p", 150), skewed("s", 60), rng.randint(100, 5000) / 100) for _ in range(6000)],
        columns=["order_id", "product_id", "seller_id", "price"],
    )
    orders = pd.DataFrame(
        [(f"o{i}", skewed("c", 90), rng.choice(["delivered", "canceled", "shipped"]),
          dt.datetime(2016, 6, 1) + dt.timedelta(hours=rng.randint(0, 24 * 900))) for i in range(380)],
        columns=["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    )
    products = pd.DataFrame([(f"p{i}", skewed("k", 9)) for i in range(140)], columns=["product_id", "product_category_name"])
    names = pd.DataFrame([(f"k{i}", f"name {i}") for i in range(8)],
                         columns=["product_category_name", "product_category_name_english"])
    places = pd.DataFrame([(f"s{i}", int(skewed("", 9)), skewed("city", 5), skewed("state", 3)) for i in range(55)],
                          columns=["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"])
    geo = pd.DataFrame([(int(skewed("", 7)), rng.randint(-30, 0), rng.randint(-60, -40)) for _ in range(200)],
                       columns=["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"]).astype(
                           {"geolocation_lat": float, "geolocation_lng": float})
    people = pd.DataFrame([(f"c{i}", skewed("u", 20)) for i in range(91)], columns=["customer_id", "customer_unique_id"])
    return {"items": items, "orders": orders, "products": products, "names": names, "places": places, "geo": geo,
            "people": people}


@pytest.fixture(params=["broadcast", "shuffle"])
def tables(spark, frames, request):
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: spark.createDataFrame(frame) for name, frame in frames.items()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def cents(frame, column, *keys):
    return (frame[column] * 100).round().astype("int64").groupby([frame[k] for k in keys]).sum()


def test_products(tables, frames):
    sold = categories.sold_products(tables["items"], tables["products"], tables["names"])
    joined = frames["items"].merge(frames["products"]).merge(frames["names"])
    counts = joined.groupby(["product_category_name_english", "product_id"]).size().reset_index(name="n")
    best = counts.sort_values(["n", "product_id"], ascending=[False, True]).groupby("product_category_name_english").head(3)
    assert rows(categories.top_products(sold)) == sorted(best.itertuples(index=False, name=None))
    per_category = counts.groupby("product_category_name_english")["n"].sum()
    top = sorted(per_category.items(), key=lambda x: (-x[1], x[0]))
    found = [tuple(r) for r in categories.top_categories_rest(sold, 4).collect()]
    assert found == [(n, c) for c, n in top[:4]] + [(sum(n for _, n in top[4:]), "rest")]


@pytest.mark.parametrize("place", ["seller_state", "seller_city"])
def test_sellers(tables, frames, place):
    sales = sellers.seller_sales(tables["items"], tables["places"])
    earned = cents(frames["items"], "price", "seller_id").reset_index(name="c").merge(frames["places"])
    ranks = earned.groupby(place)["c"].rank(method="min", ascending=False)
    best = earned[ranks <= 2]
    assert rows(sellers.top_sellers(sales, place), "seller_id", "revenue") == sorted(
        (s, c / 100) for s, c in zip(best["seller_id"], best["c"])
    )
    position = frames["geo"].groupby("geolocation_zip_code_prefix").mean()
    at = earned.merge(position, how="left", left_on="seller_zip_code_prefix", right_index=True).groupby(place)
    wanted = {p: (g["c"].sum() / 100, len(g), g["geolocation_lat"].mean(), g["geolocation_lng"].mean()) for p, g in at}
    totals = sellers.place_totals(sales, tables["geo"], place, "seller_id")
    found = {r[0]: tuple(r)[1:] for r in totals.collect()}
    assert found.keys() == wanted.keys()
    for p, values in wanted.items():
        assert found[p][:2] == values[:2]
        assert found[p][2:] == pytest.approx(values[2:])


def test_seller_months(tables, frames):
    total = cents(frames["items"], "price", "seller_id")
    best = total[total.rank(method="min", ascending=False) <= 3].index
    joined = frames["items"][frames["items"]["seller_id"].isin(best)].merge(frames["orders"])
    day = joined["order_purchase_timestamp"]
    joined = joined[(day.dt.month >= 8) | (day.dt.year >= 2018)]
    joined["date"] = joined["order_purchase_timestamp"].dt.to_period("M").dt.to_timestamp().dt.date
    wanted = sorted((s, d, c / 100) for (s, d), c in cents(joined, "price", "seller_id", "date").items())
    assert rows(sellers.top_seller_months(tables["items"], tables["orders"])) == wanted


def test_spenders(tables, frames):
    payments = tables["items"].selectExpr("order_id", "price AS payment_value")
    orders = frames["orders"][(frames["orders"]["order_status"] != "canceled")]
    joined = frames["items"].merge(orders[orders["order_purchase_timestamp"].dt.year == 2017])
    joined["month"] = joined["order_purchase_timestamp"].dt.month
    paid = spenders.month_payments(tables["orders"], payments, year=2017)

    def winners(frame, who):
        sums = cents(frame, "price", "month", who).reset_index(name="c").sort_values(["c", who], ascending=[False, True])
        return sorted((m, w, c / 100) for m, w, c in sums.groupby("month").head(1).itertuples(index=False, name=None))

    assert rows(spenders.month_spending(paid)) == winners(joined, "customer_id")
    unique = spenders.month_spending_unique(paid, tables["people"])
    best = winners(joined.merge(frames["people"]), "customer_unique_id")
    ids = frames["people"].groupby("customer_unique_id")["customer_id"].apply(sorted)
    assert rows(unique) == sorted((*row, i) for row in best for i in map(str, ids[row[1]]))
