"""Assembling the listing table from cards, descriptions and stock readings.

Rows are aligned by key ``(page_id, pos_in_pg)``, never by list position, so
every attach is an equi-join the planner can co-partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import extract, relevance, stock as stock_ops
from ..functions import text as TX

POSITION_KEYS = ("page_id", "pos_in_pg")

# Fixed value: column order of the listing record (then our page_id and report_date).
LISTING_COLUMNS = ["sku", "brand", "quantity", "price", "price_if_discounted", "pos_in_pg",
                   "stock", "description", "report_time"]


def attach_by_position(left: DataFrame, right: DataFrame, keys: Sequence[str] = POSITION_KEYS,
                       how: str = "left") -> DataFrame:
    """Attach the columns of ``right`` to ``left`` rows with the same page position."""
    return left.join(right, on=list(keys), how=how)


def append_by_name(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; columns missing on one side become NULL; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stride_chunks(df: DataFrame, ord_col: str, n: int) -> DataFrame:
    """Stride split of an ordered list into ``n`` chunks: chunk = ord mod n, position = ord div n."""
    o = F.col(ord_col)
    # exact integer floor division (consistent with pmod for any sign)
    pos = F.expr(f"(`{ord_col}` - pmod(`{ord_col}`, {int(n)})) div {int(n)}")
    return df.withColumn("chunk", F.pmod(o, F.lit(n)).cast("int")).withColumn("pos_in_chunk", pos.cast("bigint"))


def spread(df: DataFrame, ord_col: str, n: int) -> DataFrame:
    """``stride_chunks``, each chunk dealt to the partition of its number (``n`` partitions)."""
    return stride_chunks(df, ord_col, n).repartitionById(n, "chunk")


def pick(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column pick and order."""
    return df.select(*cols)


def card_fields(cards: DataFrame, price: str = "price_text",
                discounted: str = "discounted_price_text") -> DataFrame:
    """Typed card columns: price and discounted price parsed from their text."""
    return cards.withColumn("price", TX.money(price)).withColumn("price_if_discounted", TX.money(discounted))


def build_listings(cards: DataFrame, descriptions: DataFrame, observations: DataFrame,
                   description_marker: str | None = None) -> DataFrame:
    """Listing rows of the relevant cards: the search-page form.

    ``cards``: page_id, pos_in_pg, brand, sku, quantity, price_text,
    discounted_price_text, optionally captured_at (each page tagged with its
    brand). The relevance
    filter runs first, on the cards, before any join. Stock is folded from the
    observations (skew-safe) together with the time its reading ended
    (``report_time``); descriptions are attached by position with
    ``description_marker`` where none was fetched.
    """
    rel = relevance.brand_prefix_filter(card_fields(cards))
    stocks = stock_ops.fold_stock(observations, POSITION_KEYS, time_col="observed_at") \
        .withColumnRenamed("seen_at", "report_time")
    out = attach_by_position(rel, stocks)
    # one description per position (the greatest text of several), on the join's own partitioning
    texts = descriptions.groupBy(*POSITION_KEYS).agg(F.max("description").alias("description"))
    out = attach_by_position(out, texts)
    out = out.withColumn("description", extract.with_default(TX.one_line("description"), description_marker))
    if "captured_at" in out.columns:
        # a card with no observation at all still belongs to its page's run (stock NULL: failed)
        out = out.withColumn("report_time", F.coalesce("report_time", "captured_at"))
    return out.select(*LISTING_COLUMNS, "page_id")
