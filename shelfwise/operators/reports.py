"""Reports over a listings table: run summary, counts, spans, slowest brand, gaps.

A listings table has at least ``sku, brand, stock, description, report_time``.
``listing_facts`` narrows it to what the counts need, so a caller holding a
narrow form (see ``plans.views.listing_facts_view``) never moves sku or
description text through a shuffle.

Every aggregate here is mergeable (counts, min, max, ``min_by``): Spark runs a
partial aggregate in each scan task and shuffles one row per brand and task,
so a brand holding a third of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timefmt as TF

DEFAULT_PLATFORM = "shop"

FACT_COLUMNS = ["brand", "sku_present", "stock", "desc_len", "report_time"]

# Display headings of the run summary, in column order.
DISPLAY_HEADINGS = {
    "platform": "platform",
    "skus": "SKUs",
    "skus_out_of_stock": "SKUs out of stock",
    "skus_failed_stock": "SKUs failed to scrape stock",
    "brands_failed_stock": "brands failed to scrape stock",
    "skus_not_described": "SKUs not described",
    "stocking_start_time": "stocking start time",
    "time_to_scrape_stocks": "time to scrape stocks",
    "longest_stock_to_scrape": "longest stock to scrape",
    "longest_time_to_scrape_stock": "longest time to scrape stock",
}


def listing_facts(listings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Narrow projection used by all counts: presence and length flags instead of text.

    Report times stay as they are: every report truncates to whole seconds
    after aggregating (truncation is monotonic, so min and max commute with it),
    which costs per group instead of per row.
    """
    return listings.select(
        *keep, "brand", F.col("sku").isNotNull().alias("sku_present"), F.col("stock").cast("bigint").alias("stock"),
        F.length("description").cast("bigint").alias("desc_len"), "report_time")


def _facts(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df if "sku_present" in df.columns else listing_facts(df, keep)


def _count_sku(cond: Column | None = None) -> Column:
    c = F.col("sku_present") if cond is None else (F.col("sku_present") & cond)
    return F.count(F.when(c, F.lit(1)))


def brand_rollup(listings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per brand (NULL brand included) with every mergeable measure of the summary.

    ``by``: further keys, a run's day say; ``merge_rollups`` puts such rows together again.
    """
    f = _facts(listings, by)
    return f.groupBy(*by, "brand").agg(
        _count_sku().alias("skus"),
        _count_sku(F.col("stock") == 0).alias("skus_out_of_stock"),
        _count_sku(F.col("stock").isNull()).alias("skus_failed_stock"),
        _count_sku(F.col("desc_len") == 0).alias("skus_not_described"),
        TF.to_seconds_ntz(F.min("report_time")).alias("first_time"),
        TF.to_seconds_ntz(F.max("report_time")).alias("last_time"))


def merge_rollups(rollups: DataFrame) -> DataFrame:
    """Rows of ``brand_rollup`` of any number of runs as one row per brand: counts add, times widen."""
    return rollups.groupBy("brand").agg(
        *[F.sum(c).alias(c) for c in ("skus", "skus_out_of_stock", "skus_failed_stock", "skus_not_described")],
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def brand_bitmaps(listings: DataFrame, brands: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Which brands of the list (brand, ord) have a row, as bitmaps of their numbers: (by, bucket, bits).

    A bucket covers a fixed range of numbers, so a state row is of bounded size for any list.
    """
    n = F.col("ord").cast("bigint") + 1                   # Spark's bitmaps count from 1
    return listings.select(*by, "brand").join(brands.select("brand", "ord"), "brand") \
        .groupBy(*by, F.bitmap_bucket_number(n).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits"))


def brands_in(bitmaps: DataFrame) -> DataFrame:
    """Number of different brands in the bitmaps of any number of runs."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")) \
        .agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("brands_seen"))


def _brand_count(n_brands: int | DataFrame) -> Column:
    if isinstance(n_brands, DataFrame):
        return n_brands.select(F.count(F.lit(1))).scalar()
    return F.lit(int(n_brands)).cast("bigint")


def run_summary(listings: DataFrame, n_brands: int | DataFrame,
                platform: str = DEFAULT_PLATFORM) -> DataFrame:
    """The one-row run report; no row when the listings are empty.

    Columns: platform, skus, skus_out_of_stock, skus_failed_stock,
    brands_failed_stock (brands of the list with no row at all),
    skus_not_described (empty description only; NULL and failure markers are
    not counted), stocking_start_time, time_to_scrape_stocks (``HH:MM:SS`` of
    the whole run, days dropped), longest_stock_to_scrape (brand with the
    longest span text; ties by brand, NULL last) and its span text.

    Plan: scan -> partial aggregate per brand -> shuffle (rows = brands x
    tasks) -> final per-brand aggregate -> one global aggregate over the
    brand rows. The slowest brand is a ``min_by`` inside that same aggregate,
    so there is no second scan and no join.
    """
    return summary_of(brand_rollup(listings), n_brands, platform)


def summary_of(per_brand: DataFrame, n_brands: int | DataFrame, platform: str = DEFAULT_PLATFORM) -> DataFrame:
    """The run report of one rollup row per brand."""
    per_brand = per_brand.withColumn("span_s", TF.span_seconds("first_time", "last_time"))
    rank = F.struct(F.col("span_s").isNull(), -F.coalesce(TF.span_rank_key("span_s"), F.lit(0)),
                    F.col("brand").isNull(), F.coalesce(F.col("brand"), F.lit("")))
    g = per_brand.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.sum("skus").alias("skus"),
        F.sum("skus_out_of_stock").alias("skus_out_of_stock"),
        F.sum("skus_failed_stock").alias("skus_failed_stock"),
        F.count("brand").alias("brands_seen"),
        F.sum("skus_not_described").alias("skus_not_described"),
        F.min("first_time").alias("stocking_start_time"),
        F.max("last_time").alias("stocking_end_time"),
        F.min_by(F.struct("brand", "span_s"), rank).alias("slowest"))
    return g.filter(F.col("n_groups") > 0).select(
        F.lit(platform).alias("platform"),
        "skus", "skus_out_of_stock", "skus_failed_stock",
        (_brand_count(n_brands) - F.col("brands_seen")).alias("brands_failed_stock"),
        "skus_not_described",
        "stocking_start_time",
        TF.span_text(TF.span_seconds("stocking_start_time", "stocking_end_time")).alias("time_to_scrape_stocks"),
        F.col("slowest.brand").alias("longest_stock_to_scrape"),
        TF.span_text(F.col("slowest.span_s")).alias("longest_time_to_scrape_stock"))


def with_display_headings(summary: DataFrame) -> DataFrame:
    """The summary with its display headings (names with spaces) for the hand-over table."""
    return summary.select(*[F.col(c).alias(DISPLAY_HEADINGS.get(c, c)) for c in summary.columns])


RUN_SUMMARY_SQL = """
select :platform as platform, skus, skus_out_of_stock, skus_failed_stock,
       {n_brands} - brands_seen as brands_failed_stock, skus_not_described,
       lo - make_dt_interval(0, 0, 0, date_part('SECOND', lo) - second(lo)) as stocking_start_time,
       format_string('%02d:%02d:%02d', run_s div 3600, (run_s % 3600) div 60, run_s % 60) as time_to_scrape_stocks,
       slowest.brand as longest_stock_to_scrape,
       format_string('%02d:%02d:%02d', slowest.span_s div 3600, (slowest.span_s % 3600) div 60, slowest.span_s % 60)
         as longest_time_to_scrape_stock
from (
  select count(*) as n_groups, sum(skus) as skus, sum(oos) as skus_out_of_stock, sum(failed) as skus_failed_stock,
         count(brand) as brands_seen, sum(undesc) as skus_not_described, min(lo) as lo,
         pmod(datediff(to_date(max(hi)), to_date(min(lo))) * 86400L
              + (hour(max(hi)) * 3600 + minute(max(hi)) * 60 + second(max(hi)))
              - (hour(min(lo)) * 3600 + minute(min(lo)) * 60 + second(min(lo))), 86400) as run_s,
         min_by(named_struct('brand', brand, 'span_s', span_s),
                named_struct('n', span_s is null, 's', -coalesce(span_s, 0), 'b', brand is null,
                             'v', coalesce(brand, ''))) as slowest
  from (
    select brand, count(sku) as skus, count(case when stock = 0 then sku end) as oos,
           count(case when stock is null then sku end) as failed,
           count(case when length(description) = 0 then sku end) as undesc,
           min(report_time) as lo, max(report_time) as hi,
           pmod(datediff(to_date(max(report_time)), to_date(min(report_time))) * 86400L
                + (hour(max(report_time)) * 3600 + minute(max(report_time)) * 60 + second(max(report_time)))
                - (hour(min(report_time)) * 3600 + minute(min(report_time)) * 60 + second(min(report_time))),
                86400) as span_s
    from {listings} group by brand))
where n_groups > 0
"""


def run_summary_sql(listings: DataFrame, n_brands: int,
                    platform: str = DEFAULT_PLATFORM) -> DataFrame:
    """The run summary written as Spark SQL over a DataFrame argument (same plan shape)."""
    return listings.sparkSession.sql(RUN_SUMMARY_SQL.format(n_brands=int(n_brands), listings="{listings}"),
                                     args={"platform": platform}, listings=listings)


def stock_counts(listings: DataFrame) -> DataFrame:
    f = _facts(listings)
    return f.agg(_count_sku().alias("skus"),
                 _count_sku(F.col("stock") == 0).alias("skus_out_of_stock"),
                 _count_sku(F.col("stock").isNull()).alias("skus_failed_stock"))


def brands_missing(listings: DataFrame, n_brands: int | DataFrame) -> DataFrame:
    """Brands of the list with no row: ``N - count(distinct brand)`` (exact)."""
    return listings.select("brand").agg(
        (_brand_count(n_brands) - F.count_distinct("brand")).alias("brands_failed_stock"))


def undescribed_count(listings: DataFrame) -> DataFrame:
    f = _facts(listings)
    return f.agg(_count_sku(F.col("desc_len") == 0).alias("skus_not_described"))


def time_bounds(df: DataFrame, ts: str = "report_time") -> DataFrame:
    """First and last report time (whole seconds), span in seconds and as text."""
    g = df.agg(TF.to_seconds_ntz(F.min(ts)).alias("stocking_start_time"),
               TF.to_seconds_ntz(F.max(ts)).alias("stocking_end_time"))
    s = TF.span_seconds("stocking_start_time", "stocking_end_time")
    return g.select("stocking_start_time", "stocking_end_time", s.alias("span_seconds"),
                    TF.span_text(s).alias("time_to_scrape_stocks"))


def brand_span(df: DataFrame, brand: str = "brand", ts: str = "report_time") -> DataFrame:
    """Per brand: first and last report time, span seconds and span text."""
    g = df.groupBy(brand).agg(TF.to_seconds_ntz(F.min(ts)).alias("first_time"),
                              TF.to_seconds_ntz(F.max(ts)).alias("last_time"))
    s = TF.span_seconds("first_time", "last_time")
    return g.select(brand, "first_time", "last_time", s.alias("span_seconds"),
                    TF.span_text(s).alias("span_text"))


def slowest_brand(df: DataFrame, brand: str = "brand", ts: str = "report_time") -> DataFrame:
    """The brand with the longest span (seconds, ties by brand ascending, NULL last): top-1."""
    spans = brand_span(df, brand, ts).select(brand, "span_seconds", "span_text")
    return spans.orderBy(F.col("span_seconds").desc_nulls_last(), F.col(brand).asc_nulls_last()).limit(1)


def slowest_brand_daily(df: DataFrame, brand: str = "brand", ts: str = "report_time") -> DataFrame:
    """Per report day, the brand with the longest span that day.

    Two mergeable aggregates (per day and brand, then per day with ``min_by``),
    no window: a day with millions of brands is never held in one task.
    """
    per = df.groupBy(F.to_date(ts).alias("report_date"), F.col(brand).alias(brand)).agg(
        TF.to_seconds_ntz(F.min(ts)).alias("first_time"), TF.to_seconds_ntz(F.max(ts)).alias("last_time"))
    per = per.withColumn("span_seconds", TF.span_seconds("first_time", "last_time"))
    key = F.struct(F.col("span_seconds").isNull(), -F.coalesce("span_seconds", F.lit(0)),
                   F.col(brand).isNull(), F.col(brand))
    day = per.groupBy("report_date").agg(F.min_by(F.struct(brand, "span_seconds"), key).alias("top"))
    return day.select("report_date", F.col("top").getField(brand).alias(brand),
                      F.col("top.span_seconds").alias("span_seconds"),
                      TF.span_text(F.col("top.span_seconds")).alias("span_text"))


def elapsed_by(df: DataFrame, key: str, ts: str = "report_time") -> DataFrame:
    """Per key: elapsed minutes between first and last time, ``round(s/60, 2)``."""
    g = brand_span(df, key, ts)
    return g.select(key, "span_seconds", TF.elapsed_minutes("span_seconds").alias("elapsed_minutes"))


def replenish_list(listings: DataFrame) -> DataFrame:
    """Rows out of stock (stock = 0; NULL means collection failed and is not listed)."""
    return listings.filter(F.col("stock") == 0)


def description_reason(description: str = "description", marker: str = "ERROR") -> Column:
    d = F.col(description)
    return (F.when(d.isNull(), F.lit("missing"))
            .when(d == F.lit(marker), F.lit("failed"))
            .when(F.length(d) == 0, F.lit("empty")))


def description_gaps(listings: DataFrame, marker: str = "ERROR") -> DataFrame:
    """Rows whose description is missing, failed to load, or empty, with the reason."""
    return listings.withColumn("gap_reason", description_reason("description", marker)) \
        .filter(F.col("gap_reason").isNotNull())


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a fixed order (top-n, TakeOrderedAndProject)."""
    return df.orderBy(*order_by).limit(n)
