"""Command lines (``spark-submit -m shelfwise`` or ``python -m shelfwise``): the daily
search-page run, and the catalogue run.

    python -m shelfwise --pages <parquet dir | html root> --descriptions <parquet>
        --observations <parquet> --brands "A,B,C" --out <dir> --day 2024-03-01
    python -m shelfwise catalogue --pages <parquet dir | html root> --observations <parquet>
        --brands "A,B,C" --out <dir> --run 2024-03-01

Uses the session the cluster provides (``getOrCreate``); prints the one-row
run summary, or the first rows of the history sheet and its length.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import catalogue, daily
from .schemas import DESCRIPTIONS, STOCK_OBSERVATIONS
from .sources import landed


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="shelfwise", description="daily search-page run")
    p.add_argument("--pages", required=True, help="landed pages: Parquet folder, or HTML root with --html")
    p.add_argument("--html", action="store_true", help="pages are HTML files under brand=<name>/ folders")
    p.add_argument("--descriptions", required=True, help="Parquet: page_id, pos_in_pg, description")
    p.add_argument("--observations", required=True, help="Parquet: add-to-bag observations")
    p.add_argument("--brands", required=True, help="comma-separated brand list")
    p.add_argument("--out", required=True, help="output folder (listings table, CSV exports)")
    p.add_argument("--day", required=True, help="report date, yyyy-MM-dd")
    p.add_argument("--marker", default=None, help="description when none was fetched (default NULL)")
    p.add_argument("--platform", default="shop")
    return p.parse_args(argv)


def parse_catalogue_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="shelfwise catalogue", description="catalogue run with history")
    p.add_argument("--pages", required=True, help="landed pages: Parquet folder, or HTML root with --html")
    p.add_argument("--html", action="store_true", help="pages are HTML files")
    p.add_argument("--observations", required=True, help="Parquet: add-to-bag observations")
    p.add_argument("--brands", required=True, help="comma-separated portfolio")
    p.add_argument("--out", required=True, help="output folder (history table, sheet)")
    p.add_argument("--run", required=True, help="name of the run; the same name again replaces its rows")
    return p.parse_args(argv)


def _pages(spark: SparkSession, a: argparse.Namespace):
    return landed.read_landed_html(spark, a.pages) if a.html else landed.read_landed_parquet(spark, a.pages)


def _brands(a: argparse.Namespace) -> list[str]:
    return [b.strip() for b in a.brands.split(",") if b.strip()]


def main_catalogue(argv: list[str]) -> list:
    a = parse_catalogue_args(argv)
    spark = SparkSession.builder.appName("shelfwise-catalogue").getOrCreate()
    obs = spark.read.schema(STOCK_OBSERVATIONS).parquet(a.observations)
    sheet = catalogue.catalogue_run(spark, _pages(spark, a), obs, _brands(a), a.out, a.run)
    first = sheet.limit(5).collect()
    for row in first:
        print(row.asDict())
    print(f"{sheet.count()} rows")
    return first


def main(argv: list[str] | None = None) -> list:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["catalogue"]:
        return main_catalogue(argv[1:])
    a = parse_args(argv)
    spark = SparkSession.builder.appName("shelfwise-daily").getOrCreate()
    desc = spark.read.schema(DESCRIPTIONS).parquet(a.descriptions)
    obs = spark.read.schema(STOCK_OBSERVATIONS).parquet(a.observations)
    summary = daily.daily_run(spark, _pages(spark, a), desc, obs, _brands(a), a.out, a.day, a.marker, a.platform).collect()
    for row in summary:
        print(row.asDict())
    return summary


if __name__ == "__main__":
    main()
