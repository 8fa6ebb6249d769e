"""Daily refresh of the reports: each batch of new rows is read once, and what it adds is stored in a form that adds up.

A batch holds new orders, items and payments; items and payments may come before or after their order. What a batch adds to
a report is a small table of sums by key. The reports come from the sums over all batches, so a run reads the new rows and
the sums, and no row of an earlier batch. A ledger names the batches taken; one that is there already changes nothing, and a
run that dies before its ledger entry leaves nothing behind that counts.

Payments and items need their order's month. Those whose order isn't there yet wait in a table of their own; orders are kept
as narrow rows (id, customer, status, day), which only payments and items of older orders are joined with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_date, month_start, sum_cents, to_amount
from ..operators import by_shuffle, require_unique, top_ranked
from ..sources import Published, Snapshots, materialize, side_by_side
from . import bundle, categories, sellers, spenders

# What batches add up to: the keys of each table of sums, and its sum.
SUMS = {
    "order_summary": (["order_status", "undelivered", "days_late", "two_days"], "no_orders"),
    "product_items": (["product_id"], "items"),
    "seller_earnings": (["seller_id"], "earned"),
    "month_payments": (["year", "order_purchase_month", "order_status", "customer_id"], "paid"),
    "seller_months": (["seller_id", "date"], "earned"),
}
# Sums per order that wait for it: their keys, and the sum.
WAITING = {"payments": (["order_id"], "paid"), "items": (["order_id", "seller_id"], "earned")}
FACTS = ("orders", "order_items", "order_payments")


def _sum(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).alias(measure))


class ReportStore:
    """Sums per batch below one folder, the ledger of batches, and the published result tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ledger = Snapshots(spark, f"{self.folder}/ledger")
        self.published = Published(spark, f"{self.folder}/reports")

    def batches(self) -> list[str]:
        return self.ledger.latest()[1].get("batches", [])

    def _read(self, paths: Sequence[str]) -> DataFrame | None:
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, batch: str, tables: Mapping[str, DataFrame], check_orders: bool = True) -> bool:
        """Take a batch of new ``orders``, ``order_items`` and ``order_payments``; False if the ledger has it already.

        Each order comes in one batch, once. ``check_orders`` fails the run where one of the batch came before; that
        reads the ids of all orders.
        """
        number, state = self.ledger.latest()
        if batch in state.get("batches", []):
            return False
        home = f"{self.folder}/batches/{uuid.uuid4().hex}"
        keep = partial(materialize, folder=home)
        orders, items, payments = (tables[name] for name in FACTS)
        placed = orders.filter(F.col("order_id").isNotNull()).select(
            "order_id", "customer_id", "order_status", as_date(orders, spenders.PURCHASE).alias("day")
        )
        new = {
            "payments": payments.groupBy("order_id").agg(sum_cents("payment_value").alias("paid")),
            "items": items.filter(F.col("seller_id").isNotNull()).groupBy("order_id", "seller_id").agg(
                sum_cents("price").alias("earned")
            ),
        }
        waiting = {name: self._read(state.get("waiting", {}).get(name, ())) for name in WAITING}

        def open_sums(name: str) -> DataFrame:
            known = new[name].filter(F.col("order_id").isNotNull())
            return known if waiting[name] is None else _sum(known.unionByName(waiting[name]), *WAITING[name])

        jobs = {
            "placed": lambda: placed,
            "order_summary": lambda: bundle.order_summary(orders),
            "product_items": lambda: categories.items_per_product(items),
            "seller_earnings": lambda: sellers.seller_earnings(items),
            **{f"open_{name}": partial(open_sums, name) for name in WAITING},
        }
        done = dict(zip(jobs, side_by_side(self.spark, [lambda n=n, j=j: keep(j(), name=n) for n, j in jobs.items()])))
        orders_now, old = by_shuffle(done["placed"]), self._read(state.get("placed", ()))
        old = None if old is None else by_shuffle(old)
        if check_orders and old is not None:
            again = orders_now.join(old.select("order_id"), "order_id", "left_semi")
            if not again.isEmpty():
                raise ValueError(f"batch {batch} has orders of an earlier batch")

        def met(name: str) -> DataFrame:
            """The sums whose order is known, with that order."""
            own = done[f"open_{name}"]
            found = own.join(orders_now, "order_id")
            if old is None:
                return found
            late = own.join(orders_now, "order_id", "left_anti").join(old, "order_id")
            return found.unionByName(late)

        def left(name: str) -> DataFrame:
            own = done[f"open_{name}"].join(orders_now, "order_id", "left_anti")
            return own if old is None else own.join(old, "order_id", "left_anti")

        month = {"year": F.year("day"), "order_purchase_month": F.month("day"), "date": month_start(F.col("day"))}
        jobs = {
            "month_payments": lambda: _sum(met("payments").withColumns(month), *SUMS["month_payments"]),
            "seller_months": lambda: _sum(met("items").withColumns(month), *SUMS["seller_months"]),
            **{f"waiting_{name}": partial(left, name) for name in WAITING},
            "latest": lambda: done["placed"].agg(F.max("day").alias("day")),
        }
        side_by_side(self.spark, [lambda n=n, j=j: keep(j(), name=n) for n, j in jobs.items()])
        sums = state.get("sums", {})
        self.ledger.commit(number, {
            "batches": [*state.get("batches", []), batch],
            "sums": {name: [*sums.get(name, []), f"{home}/{name}"] for name in SUMS},
            "placed": [*state.get("placed", []), f"{home}/placed"],
            "latest": [*state.get("latest", []), f"{home}/latest"],
            "waiting": {name: [f"{home}/waiting_{name}"] for name in WAITING},
        })
        return True

    def compact(self) -> None:
        """Make one table of sums of those of all batches, so that the number of files doesn't grow with the days."""
        number, state = self.ledger.latest()
        if not number:
            return
        home = f"{self.folder}/batches/{uuid.uuid4().hex}"
        jobs = {name: partial(self.sums, name) for name in SUMS}
        jobs |= {"placed": lambda: self._read(state["placed"]), "latest": lambda: self._read(state["latest"]).agg(F.max("day").alias("day"))}
        side_by_side(self.spark, [lambda n=n, j=j: materialize(j(), home, n) for n, j in jobs.items()])
        sums = {name: [f"{home}/{name}"] for name in SUMS}
        self.ledger.commit(number, {**state, "sums": sums, "placed": [f"{home}/placed"], "latest": [f"{home}/latest"]})

    def sums(self, name: str) -> DataFrame:
        """The sums over all batches taken."""
        paths = self.ledger.latest()[1].get("sums", {}).get(name)
        if not paths:
            raise ValueError(f"{self.folder} has taken no batch")
        return _sum(self._read(paths), *SUMS[name])

    def month_payments(self, year: int | None = None, excluded_status: str = "canceled") -> DataFrame:
        """As ``spenders.month_payments``; the default year is the one before that of the newest order."""
        if year is None:
            year = self._read(self.ledger.latest()[1]["latest"]).agg((F.year(F.max("day")) - 1).alias("year")).scalar()
        paid = self.sums("month_payments").filter((F.col("year") == year) & (F.col("order_status") != excluded_status))
        return _sum(paid, ["order_purchase_month", "customer_id"], "paid")

    def top_seller_months(self, n: int = 3, *, since: str) -> DataFrame:
        """``seller_id, date, month_earnings`` of the sellers with overall rank <= n, for months from that of ``since`` on.
        Sellers are ranked by all items, those that still wait for their order too."""
        best = top_ranked(self.sums("seller_earnings"), [], "earned", n).select("seller_id")
        months = self.sums("seller_months").filter(F.col("date") >= month_start(F.lit(since).cast("date")))
        found = months.join(best, "seller_id", "left_semi")
        return found.select("seller_id", "date", to_amount("earned").alias("month_earnings"))

    def parts(self, tables: Mapping[str, DataFrame], settings: bundle.Settings) -> dict[str, Callable[[], DataFrame]]:
        """The summary tables of all report families. ``tables`` are the lookup tables as they are now."""
        translation = tables["category_translation"]
        return {
            "order_summary": lambda: self.sums("order_summary"),
            "sold_products": lambda: categories.with_category(
                by_shuffle(self.sums("product_items")), tables["products"], translation
            ),
            "month_payments": lambda: self.month_payments(settings.year, settings.excluded_status),
            "seller_sales": lambda: sellers.with_place(
                by_shuffle(self.sums("seller_earnings")), require_unique(tables["sellers"], "seller_id")
            ),
            "zip_positions": lambda: sellers.zip_positions(tables["geolocation"]),
        }

    def refresh(self, tables: Mapping[str, DataFrame], settings: bundle.Settings = bundle.Settings()) -> int:
        """Publish all result tables anew from the sums; readers see all of them change at once. Returns the version."""

        def write(folder: str) -> list[str]:
            return bundle.write_from(self.spark, self.parts(tables, settings), tables, folder, settings=settings)

        return self.published.publish(write)

    def open(self, table: str) -> DataFrame:
        return self.published.open(table)

