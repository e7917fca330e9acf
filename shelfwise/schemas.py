"""Declared schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


S, L, I, D, B, TS, DT = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
                         T.TimestampNTZType(), T.DateType())

BRANDS = _s(("brand", S, False), ("ord", I, False))

LANDED_PAGES = _s(("page_id", L, False), ("url", S, True), ("brand", S, True), ("location", S, True),
                  ("captured_at", TS, True), ("html", S, True))

CARDS_RAW = _s(("page_id", L, False), ("pos_in_pg", L, False), ("brand", S, True), ("sku", S, True),
               ("quantity", S, True), ("price_text", S, True), ("discounted_price_text", S, True))

STOCK_OBSERVATIONS = _s(("page_id", L, False), ("pos_in_pg", L, False), ("step", I, False),
                        ("bag_text", S, True), ("limit_marker", B, True), ("counter_present", B, True),
                        ("failed", B, True), ("observed_at", TS, True))

DESCRIPTIONS = _s(("page_id", L, False), ("pos_in_pg", L, False), ("description", S, True))

LISTINGS = _s(("sku", S, True), ("brand", S, True), ("quantity", S, True), ("price", D, True),
              ("price_if_discounted", D, True), ("pos_in_pg", L, True), ("stock", L, True),
              ("description", S, True), ("report_time", TS, True), ("page_id", L, True),
              ("report_date", DT, True))

HISTORY_TEXT = _s(("sku", S, True), ("stock", S, True), ("location", S, True), ("report_time", S, True))

BRAND_ROLLUP = _s(("brand", S, True), ("skus", L, True), ("skus_out_of_stock", L, True), ("skus_failed_stock", L, True),
                  ("skus_not_described", L, True), ("first_time", TS, True), ("last_time", TS, True))

RUN_SUMMARY = _s(("platform", S, False), ("skus", L, True), ("skus_out_of_stock", L, True),
                 ("skus_failed_stock", L, True), ("brands_failed_stock", L, True),
                 ("skus_not_described", L, True), ("stocking_start_time", TS, True),
                 ("time_to_scrape_stocks", S, True), ("longest_stock_to_scrape", S, True),
                 ("longest_time_to_scrape_stock", S, True))
