"""shelfwise: shelf-stock and listing-content analytics on Spark.

Landed product pages become typed listing tables (cards, prices, quantities,
descriptions); rows are matched to brands; units in stock are folded from
add-to-bag observations; history is appended by date; reports give products
out of stock, failed collections, brands with no listing and run spans.

The public names below are plain functions ``DataFrame -> DataFrame`` or
column expressions; the modules hold the rest.
"""

from .functions.html import first_text
from .functions.text import money, one_line, row_label, strip_spaces, units
from .operators.extract import parse_cards as cards
from .operators.extract import regex_cards
from .operators.listings import append_by_name, attach_by_position, build_listings, stride_chunks
from .operators.relevance import (brand_prefix, brand_prefix_filter, brand_prefix_join, portfolio_flag,
                                  portfolio_semi_join)
from .operators.reports import (brand_span, description_gaps, replenish_list, run_summary, slowest_brand,
                                slowest_brand_daily)
from .operators.stock import fold_stock
from .sources.history import append_history, union_with_history
from .sources.sinks import write_dated_csv, write_listings

__version__ = "0.1.0"

__all__ = [
    "append_by_name", "append_history", "attach_by_position", "brand_prefix", "brand_prefix_filter",
    "brand_prefix_join", "brand_span", "build_listings", "cards", "description_gaps", "first_text",
    "fold_stock", "money", "one_line", "portfolio_flag", "portfolio_semi_join", "regex_cards",
    "replenish_list", "row_label", "run_summary", "slowest_brand", "slowest_brand_daily", "stride_chunks",
    "strip_spaces", "union_with_history", "units", "write_dated_csv", "write_listings",
]
