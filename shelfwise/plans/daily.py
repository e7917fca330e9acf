"""The daily search-page run: landed pages -> listings table -> run summary.

One search page per brand is landed by the crawler (``landed_pages``, brand
set), with the fetched descriptions and the add-to-bag observations of its
cards. The run:

1. extracts the cards of every page (parser, executors; native filters first),
2. keeps the cards whose name starts with the page's brand,
3. folds stock and attaches descriptions by position,
4. writes the rows to the listings table (Parquet, one run a day; a rerun
   replaces exactly its day, once it is whole) -- the written table is the run's recovery point: the
   summary and the CSV export read it back instead of recomputing the
   extraction,
5. stores the day's partial aggregates (one row per brand), computes the one-row
   summary and writes the dated CSV export, in the order of the brand list.

Brand lists are inputs; nothing is collected but the one-row summary.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract, listings, relevance, reports
from ..schemas import BRAND_ROLLUP
from ..sources import runs, sinks

# The card and field selectors of a search page (tag, class token).
SEARCH_CARD = ("div", "imageWrapper")
SEARCH_FIELDS = {
    "sku": ("div", "name"),
    "quantity": ("div", "subText"),
    "price_text": ("div", "price"),
    "discounted_price_text": ("div", "discountedPrice"),
}


# Fixed value: the number of work chunks a brand list is dealt into; the export is in their order.
CHUNKS = 3


def search_cards(pages: DataFrame, card: tuple[str, str] = SEARCH_CARD,
                 fields: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Cards of the brand search pages (pages without a brand are skipped before parsing)."""
    tagged = pages.filter(F.col("brand").isNotNull())
    keep = ["page_id", "brand"] + (["captured_at"] if "captured_at" in pages.columns else [])
    return extract.parse_cards(tagged, card, fields or SEARCH_FIELDS, keep=keep, card_text=False)


def _join(folder: str, name: str) -> str:
    return os.path.join(folder, name) if "://" not in folder else f"{folder.rstrip('/')}/{name}"


def daily_run(spark: SparkSession, pages: DataFrame, descriptions: DataFrame, observations: DataFrame,
              brands: Sequence[str] | DataFrame, out_dir: str, day: dt.date | str,
              description_marker: str | None = None, platform: str = reports.DEFAULT_PLATFORM,
              csv_prefix: str = "stocks_data_", chunks: int = CHUNKS) -> DataFrame:
    """Run one day; returns the run summary (read from the written listings table)."""
    listed = relevance.brands_frame(spark, brands).filter(F.col("brand") != "")
    order = "ord" if "ord" in listed.columns else "brand"
    listed = listed.groupBy("brand").agg(F.min(order).alias("ord"))   # a brand listed twice counts once
    pages = pages.join(listed, "brand", "left_semi")           # only pages of listed brands
    rows = listings.build_listings(search_cards(pages), descriptions, observations, description_marker)
    table = _join(out_dir, "listings")
    sinks.write_listings(rows, table, day)
    written = sinks.read_listings(spark, table, day)
    runs.write_run(reports.brand_rollup(written), _join(out_dir, "rollups"), str(day), key=sinks.DAY)
    if order == "ord":                                         # chunk, brand in chunk, place in page
        placed = listings.stride_chunks(written.join(listed, "brand"), "ord", chunks)
        by = ["chunk", "pos_in_chunk", "page_id", "pos_in_pg"]
    else:
        placed, by = written, ["brand", "page_id", "pos_in_pg"]
    sinks.write_dated_csv(placed.orderBy(*by).select(*listings.LISTING_COLUMNS), _join(out_dir, "exports"), csv_prefix, day)
    return reports.run_summary(written, listed, platform)


def range_summary(spark: SparkSession, out_dir: str, first: dt.date, last: dt.date, brands: Sequence[str] | DataFrame,
                  platform: str = reports.DEFAULT_PLATFORM) -> DataFrame:
    """The run summary over all listings of the days ``first`` to ``last``, from the stored rollups alone."""
    days = [str(first + dt.timedelta(n)) for n in range((last - first).days + 1)]
    state = runs.read_runs(spark, _join(out_dir, "rollups"), BRAND_ROLLUP, days, key=sinks.DAY)
    listed = relevance.brands_frame(spark, brands).select("brand").filter(F.col("brand") != "").distinct()
    return reports.summary_of(reports.merge_rollups(state), listed, platform)
