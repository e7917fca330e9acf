"""The catalogue-page run: one page of all the maker's products, portfolio
filter, stock, and the history table.

Rows outside the portfolio (no brand of the list inside the product name,
case-sensitive) are dropped before stock is joined. The row label is
``'<name> <quantity>'`` (quantity with spaces removed, missing parts written
``None``), the page location is copied to every row, the report time is the
page capture time as sheet text. Rows without a stock reading are dropped.
New rows go in front of the history (text, by position); the history table
itself is a table of runs: a rerun replaces its own rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as HT
from ..functions import text as TX
from ..functions import timefmt as TF
from ..operators import extract, relevance, stock
from ..sources import history as H

# Card and field selectors of the catalogue page (tag, class token).
CATALOGUE_CARD = ("div", "product")
CATALOGUE_FIELDS = {"sku": ("div", "name"), "quantity": ("div", "subText")}
CATALOGUE_LOCATION = "metropolitanAreaName"        # class token, of any tag


def catalogue_rows(pages: DataFrame, observations: DataFrame, portfolio: Sequence[str]) -> DataFrame:
    """History rows (sku label, stock, location, report_time as text) plus ``report_date``.

    The location is the landed page's own, else the text of its first element of the location class.
    """
    pages = pages.withColumn("location", F.coalesce("location", HT.first_text("html", None, CATALOGUE_LOCATION)))
    cards = extract.parse_cards(pages, CATALOGUE_CARD, CATALOGUE_FIELDS,
                                keep=("page_id", "location", "captured_at"), card_text=False)
    cards = cards.withColumn("quantity", TX.strip_spaces("quantity"))
    cards = relevance.portfolio_filter(cards, portfolio)
    stocks = stock.fold_stock(observations, ("page_id", "pos_in_pg"), keep_text=True)
    rows = cards.join(stocks, ["page_id", "pos_in_pg"], "inner").filter(F.col("stock").isNotNull())
    return rows.select(TX.row_label("sku", "quantity").alias("sku"), F.col("stock_text").alias("stock"),
                       TX.one_line("location").alias("location"),
                       TF.format_time("captured_at", TF.SHEET_TIME).alias("report_time"),
                       F.to_date("captured_at").alias("report_date"))


def with_history(new_rows: DataFrame, history_text: DataFrame) -> DataFrame:
    """New rows first, then the history, all text (the sheet after the run)."""
    return H.union_with_history(new_rows.select(*H.HISTORY_COLUMNS), history_text.select(*H.HISTORY_COLUMNS))


def append_catalogue(new_rows: DataFrame, history_path: str, run: str | None = None) -> None:
    """Append a run's rows; a named ``run`` written again replaces its own rows."""
    H.append_history(new_rows, history_path, run=run)


def catalogue_run(spark: SparkSession, pages: DataFrame, observations: DataFrame, portfolio: Sequence[str],
                  out_dir: str, run: str) -> DataFrame:
    """One catalogue run: its rows into the history, the sheet written from the whole history.

    Returns the sheet (text, newest rows first). Running it again under the same name gives the same state.
    """
    folder = out_dir.rstrip("/")
    append_catalogue(catalogue_rows(pages, observations, portfolio), f"{folder}/history", run)
    H.write_sheet(H.read_history(spark, f"{folder}/history"), f"{folder}/sheet")
    return H.read_sheet(spark, f"{folder}/sheet")
