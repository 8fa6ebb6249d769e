"""Top-earning sellers and sales by place.

Items are summed per seller before sellers are joined. ``count`` in the place totals is the number
of sellers, one per row of that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_date, band, merge_cents, month_start, on_or_after, pick, sum_cents, to_amount
from ..operators import best_wide, join_spread, mean_by_key, top_ranked

# Band limits, marker sizes and marker colours.
COUNT_LIMITS = (1500, 200, 100, 20, 10)
REVENUE_LIMITS = (8_000_000, 1_000_000, 500_000, 50_000, 10_000)
SIZES = (25, 12, 8, 5, 3, 1)
COLORS = ("#CE4C18", "#D58321", "#D5B421", "#C3E839", "#43A85F", "#66CF83")
# Text for a place with a single seller.
ONE_SELLER = {"seller_state": "In this state is only one seller", "seller_city": "In this city is only one seller"}


def seller_earnings(order_items: DataFrame) -> DataFrame:
    """``seller_id, earned``: sum of prices in cents. Items without a seller are left out."""
    return order_items.filter(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(sum_cents("price").alias("earned"))


def with_place(earnings: DataFrame, sellers: DataFrame) -> DataFrame:
    """``seller_id, earned, zip_code, seller_city, seller_state`` for the sums of ``seller_earnings``."""
    places = sellers.select(
        "seller_id", F.col("seller_zip_code_prefix").alias("zip_code"), "seller_city", "seller_state"
    )
    return earnings.join(places, "seller_id")


def seller_sales(order_items: DataFrame, sellers: DataFrame) -> DataFrame:
    """``seller_id, earned, zip_code, seller_city, seller_state`` of every seller that sold something."""
    return with_place(seller_earnings(order_items), sellers)


def top_sellers(sales: DataFrame, place: str | Sequence[str], n: int = 2) -> DataFrame:
    """``seller_id, <place>, revenue`` of the sellers with rank <= n in their place; ties are kept."""
    places = [place] if isinstance(place, str) else list(place)
    best = top_ranked(sales.select("seller_id", *places, "earned"), places, "earned", n)
    return best.select("seller_id", *places, to_amount("earned").alias("revenue")).orderBy(F.desc("revenue"), "seller_id")


def best_sellers_wide(sales: DataFrame, place: str, k: int = 2) -> DataFrame:
    """``<place>, 1_best_seller, 2_best_seller``; equal revenues in ``seller_id`` order."""
    fill = ONE_SELLER.get(place, "In this place is only one seller")
    return best_wide(sales, place, "seller_id", "earned", k=k, fill=fill)


def zip_positions(geolocation: DataFrame) -> DataFrame:
    """``zip_code, lat, lng``: the mean position of each zip code. Totals take this in place of all positions too."""
    means = mean_by_key(geolocation, "geolocation_zip_code_prefix", lat="geolocation_lat", lng="geolocation_lng")
    return means.withColumnRenamed("geolocation_zip_code_prefix", "zip_code")


def place_totals(sales: DataFrame, geolocation: DataFrame, place: str | Sequence[str], counted: str) -> DataFrame:
    """``<place>, revenue, count, lat, lng``: totals and the mean position of the sellers.

    ``count`` counts the non-null values of ``counted``. Sellers are grouped by place and zip code
    before the positions are joined, so a zip code shared by very many sellers is a few rows there;
    the position means weigh every zip code by its sellers.
    """
    places = [place] if isinstance(place, str) else list(place)
    positions = geolocation if geolocation.columns == ["zip_code", "lat", "lng"] else zip_positions(geolocation)
    by_zip = sales.groupBy(*places, "zip_code").agg(
        merge_cents("earned").alias("earned"), F.count(counted).alias("n"), F.count(F.lit(1)).alias("sellers")
    )

    def mean(column: str):
        known = F.sum(F.when(F.col(column).isNotNull(), F.col("sellers")))
        return F.sum(F.col(column) * F.col("sellers")) / known

    return (
        by_zip.join(positions, "zip_code", "left")
        .groupBy(*places)
        .agg(
            to_amount(merge_cents("earned")).alias("revenue"),
            F.sum("n").alias("count"),
            mean("lat").alias("lat"),
            mean("lng").alias("lng"),
        )
        .orderBy("revenue", *places)
    )


def state_totals(sales: DataFrame, geolocation: DataFrame) -> DataFrame:
    return place_totals(sales, geolocation, "seller_state", counted="seller_city")


def city_totals(sales: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Totals per city name; same-named cities of different states count as one."""
    return place_totals(sales, geolocation, "seller_city", counted="seller_state")


def with_count_bands(totals: DataFrame, limits: Sequence[float] = COUNT_LIMITS) -> DataFrame:
    """Adds the marker ``size`` and ``colors`` for the number of sellers."""
    number = band(F.col("count"), limits)
    return totals.withColumns({"size": pick(number, SIZES).cast("long"), "colors": pick(number, COLORS)})


def with_revenue_bands(totals: DataFrame, limits: Sequence[float] = REVENUE_LIMITS) -> DataFrame:
    """Adds ``revenue_band``, 0 for the largest revenues to 5 for the smallest."""
    return totals.withColumn("revenue_band", band(F.col("revenue"), limits))


def map_dataset(city_bands: DataFrame, best_sellers: DataFrame) -> DataFrame:
    """City totals and bands with the names of the best sellers."""
    return city_bands.join(best_sellers, "seller_city", "left")


def top_seller_months(
    order_items: DataFrame,
    orders: DataFrame,
    n: int = 3,
    *,
    from_month: int = 8,
    from_year: int = 2018,
    since: str | None = None,
) -> DataFrame:
    """``seller_id, date, month_earnings`` of the sellers with overall rank <= n.

    Keeps months from ``from_month`` on in any year and all months from ``from_year`` on; with
    ``since`` (a date), all months from that date on instead. Items are summed per order and seller
    first: that grouping feeds the totals and the months, and neither a seller nor an order with very
    many items makes one long task.
    """
    sold = order_items.filter(F.col("seller_id").isNotNull())
    per_order = sold.groupBy("order_id", "seller_id").agg(sum_cents("price").alias("earned"))
    totals = per_order.groupBy("seller_id").agg(F.sum("earned").alias("earned"))
    best = top_ranked(totals, [], "earned", n).select("seller_id")
    day = as_date(orders, "order_purchase_timestamp")
    wanted = (F.month(day) >= from_month) | (F.year(day) >= from_year)
    if since is not None:
        wanted = on_or_after(orders, "order_purchase_timestamp", since)
    placed = orders.filter(wanted).select("order_id", month_start(day).alias("date"))
    # Only the sums of the few best sellers meet the orders. Null-safe, so that no filter comes under the grouping, which
    # then could not feed both.
    sold = join_spread(per_order, best, ["seller_id"])
    placed = placed.filter(F.col("order_id").isNotNull()).withColumnRenamed("order_id", "placed_id")
    in_months = sold.join(placed, F.col("order_id").eqNullSafe(F.col("placed_id")))
    per_month = in_months.groupBy("seller_id", "date").agg(F.sum("earned").alias("earned"))
    return (
        per_month
        .select("seller_id", "date", to_amount("earned").alias("month_earnings"))
        .orderBy("date", "seller_id")
    )
