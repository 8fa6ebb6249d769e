"""Batch job: read the input tables, write the result tables.

    spark-submit run_reports.py --parquet /data/tables --output /data/results
    spark-submit run_reports.py --csv /data/csv --prefix shop_ --suffix _dataset --output /data/results --families sellers
    spark-submit run_reports.py --parquet /data/new/2018-05-02 --store /data/store --batch 2018-05-02

Inputs are named <prefix><table><suffix>.csv or .parquet; --file TABLE=PATH overrides one. --ingest
FOLDER converts CSV to Parquet first and reads that. In cluster deploy mode add the package with
--py-files.
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession

from tradewind.plans import bundle
from tradewind.plans.refresh import ReportStore
from tradewind.sources import SCHEMAS, Published, ingest, open_csv_tables, open_tables, read_parquet


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser()
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--csv", help="folder of CSV files")
    source.add_argument("--parquet", help="folder of Parquet tables")
    parser.add_argument("--prefix", default="")
    parser.add_argument("--suffix", default="")
    parser.add_argument("--file", action="append", default=[], metavar="TABLE=PATH")
    parser.add_argument("--ingest", help="write the CSV tables to this folder as Parquet first")
    parser.add_argument("--multi-line", nargs="+", default=[], metavar="TABLE", help="CSV tables with line breaks in quotes")
    parser.add_argument("--orders-by-year", action="store_true", help="partition ingested orders by year of purchase")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--output", help="folder of result tables, each replaced as it is written")
    target.add_argument("--publish", help="folder of versions of the result tables; readers see all change at once")
    target.add_argument("--store", help="take the orders, items and payments as a batch and publish from all batches")
    parser.add_argument("--batch", help="name of the batch for --store; one taken before changes nothing")
    parser.add_argument("--families", nargs="+", choices=list(bundle.FAMILIES), default=list(bundle.FAMILIES))
    parser.add_argument("--year", type=int, help="year of the spending report; default: the last full year")
    parser.add_argument("--compression", default="zstd")
    args = parser.parse_args(argv)
    if (args.store is None) != (args.batch is None):
        parser.error("--store and --batch belong together")
    if args.ingest and args.parquet:
        parser.error("--ingest converts CSV files; it needs --csv")
    return args


def input_tables(spark: SparkSession, args: argparse.Namespace) -> bundle.Tables:
    """The tables that the chosen families need; ``--ingest`` converts all nine."""
    needed = bundle.needed_tables(args.families)
    named = dict(item.split("=", 1) for item in args.file)
    folder, ending = (args.parquet, "parquet") if args.parquet else (args.csv, "csv")
    tables = SCHEMAS if args.ingest else needed
    paths = {t: named.get(t, f"{folder.rstrip('/')}/{args.prefix}{t}{args.suffix}.{ending}") for t in tables}
    if args.parquet:
        return {table: read_parquet(spark, path) for table, path in paths.items()}
    if args.ingest:
        ingest(
            spark, paths, args.ingest, compression=args.compression, multi_line=args.multi_line,
            orders_by_year=args.orders_by_year,
        )
        return open_tables(spark, args.ingest, needed)
    return open_csv_tables(spark, paths, multi_line=args.multi_line)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("sales reports").getOrCreate()
    settings = bundle.Settings(year=args.year, compression=args.compression)
    tables = input_tables(spark, args)
    if args.store:
        store = ReportStore(spark, args.store)
        store.add(args.batch, tables)
        store.refresh(tables, settings)  # also after a run that died between the two
        names = store.published.tables()
    elif args.publish:
        published = Published(spark, args.publish)
        published.publish(partial(bundle.write_reports, spark, tables, families=args.families, settings=settings))
        names = published.tables()
    else:
        names = bundle.write_reports(spark, tables, args.output, families=args.families, settings=settings)
    for name in names:
        print(name)


if __name__ == "__main__":
    main()
