"""Registered queries over the test-data tables, each with an independent SQL check.

``QUERIES[name](spark, base)`` returns a DataFrame; ``ORACLE_SQL[name]`` is
DuckDB SQL over the same tables (registered as views by table name) that must
give the same bag of rows. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as TX
from ..functions import timefmt as TF
from ..functions import sql as sql_functions
from ..operators import asof, extract, listings, position, relevance, reports, stock, tables
from ..sources import history
from ..sources.landed import brand_urls
from ..sources.tables import read_table
from . import catalogue, daily
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values used by the registered queries (parameters of the operators).
PREFIX_BRANDS = ["Red", "Small", "Hot"]
PORTFOLIO = ["ring", "gear", "rod"]
CATALOGUE_PORTFOLIO = ["th", "en"]
SEARCH_BASE = "https://shop.example/search/"
HISTORY_CUTOFF = "2024-01-15 00:00:00"
STRIDE = 3
N_BRANDS = 30
NTH = 3
RANGE_DAYS = ("2024-01-01", "2024-01-02")

def _lv(spark, base):
    return V.listing_view(spark, base)


def _pages(spark, base):
    return read_table(spark, base, "pages")


def _events(spark, base):
    return read_table(spark, base, "events")


def _part(spark, base):
    return read_table(spark, base, "part")


def q_run_summary(spark, base):
    return reports.run_summary(V.listing_facts_view(spark, base), N_BRANDS)


def q_stock_counts(spark, base):
    return reports.stock_counts(V.listing_facts_view(spark, base))


def q_brands_missing(spark, base):
    return reports.brands_missing(_lv(spark, base), N_BRANDS)


def q_undescribed_count(spark, base):
    return reports.undescribed_count(V.listing_facts_view(spark, base))


def q_time_bounds(spark, base):
    return reports.time_bounds(_events(spark, base), ts="ts")


def q_brand_span(spark, base):
    return reports.brand_span(_events(spark, base), brand="user_id", ts="ts")


def q_slowest_brand(spark, base):
    return reports.slowest_brand(_lv(spark, base))


def q_slowest_brand_daily(spark, base):
    return reports.slowest_brand_daily(_events(spark, base), brand="user_id", ts="ts")


def q_row_count(spark, base):
    return reports.row_count(_lv(spark, base))


def q_cards_explode(spark, base):
    return V.nav_cards(spark, base)


def q_cards_by_class(spark, base):
    return extract.parse_cards(_pages(spark, base), ("div", "ad"))


def q_cards_by_tag(spark, base):
    return extract.parse_cards(_pages(spark, base), ("li", None), {"link_text": ("a", None)})


def q_cards_by_class_regex(spark, base):
    return extract.class_cards(_pages(spark, base), "div", "ad")


def q_first_text_by_class(spark, base):
    p = _pages(spark, base)
    return p.select("page_id", H.first_text("html", "div", "ad").alias("ad_text"),
                    H.first_text("html", "div", "important-banner").alias("banner_text"))


def q_cards_per_page(spark, base):
    return _pages(spark, base).select("page_id", extract.card_count(V.nav_links_array()).alias("n_cards"))


def q_page_position(spark, base):
    cards = V.nav_cards(spark, base).select("page_id", F.col("pos_in_pg").alias("ord"), "card_text")
    return extract.position_in_page(cards, "page_id", "ord").select("page_id", "pos_in_pg", "card_text")


def q_nth_card(spark, base):
    return _pages(spark, base).select("page_id", extract.nth(V.nav_links_array(), NTH).alias("card_text"))


def q_layout_switch(spark, base):
    return _pages(spark, base).select("page_id", extract.layout_section("html").alias("section"))


def q_fallback_extract(spark, base):
    p = _pages(spark, base)
    return p.select("page_id", extract.fallback(H.tag_text("html", "h2"), H.tag_text("html", "h1")).alias("heading"))


def q_page_attr_on_cards(spark, base):
    pages = _pages(spark, base).select("page_id", "html", V.page_location().alias("location"))
    return extract.regex_cards(pages, V.NAV_LINK, {"card_text": 2}, keep=("page_id", "location"))


def q_attach_by_position(spark, base):
    pages = _pages(spark, base)
    texts = extract.regex_cards(pages, V.NAV_LINK, {"card_text": 2})
    hrefs = extract.regex_cards(pages, V.NAV_LINK, {"href": 1})
    return listings.attach_by_position(texts, hrefs)


def q_price_parse(spark, base):
    t = V.price_texts(spark, base)
    return t.select("l_orderkey", "l_linenumber", "price_text",
                    TX.money("price_text").alias("price"),
                    TX.money("discounted_price_text").alias("price_if_discounted"))


def q_units_parse(spark, base):
    t = V.bag_texts(spark, base)
    return t.select("l_orderkey", "l_linenumber", "bag_text", TX.units("bag_text").alias("units"))


def q_quantity_strip(spark, base):
    return _part(spark, base).select("p_partkey", TX.strip_spaces("p_name").alias("quantity"))


def q_text_one_line(spark, base):
    d = read_table(spark, base, "documents")
    return d.select("doc_id", TX.one_line("text").alias("description"))


def q_desc_default(spark, base):
    return _lv(spark, base).select("doc_id", extract.with_default("description", V.FAILED_MARKER).alias("description"))


def q_row_label(spark, base):
    d = read_table(spark, base, "documents").select("doc_id", "source")
    lab = read_table(spark, base, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select("doc_id", TX.row_label("source", "quality").alias("label"))


def q_brand_prefix_filter(spark, base):
    rows = _part(spark, base).select("p_partkey", F.col("p_name").alias("sku"), F.lit("Red").alias("brand"))
    return relevance.brand_prefix_filter(rows)


def q_brand_prefix_join(spark, base):
    rows = _part(spark, base).select("p_partkey", F.col("p_name").alias("sku"))
    return relevance.brand_prefix_join(rows, PREFIX_BRANDS).select("p_partkey", "sku", "brand")


def q_portfolio_flag(spark, base):
    p = _part(spark, base)
    return p.select("p_partkey", F.col("p_name").alias("sku"),
                    relevance.portfolio_flag("p_name", PORTFOLIO).alias("in_portfolio"))


def q_portfolio_semi_join(spark, base):
    rows = _part(spark, base).select("p_partkey", F.col("p_name").alias("sku"))
    return relevance.portfolio_semi_join(rows, PORTFOLIO)


def q_stock_known(spark, base):
    return _lv(spark, base).filter(F.col("stock").isNotNull())


def q_stock_from_observations(spark, base):
    return stock.fold_stock(V.event_observations(spark, base), keys=["user_id"], time_col="observed_at")


def q_replenish_list(spark, base):
    return reports.replenish_list(_lv(spark, base))


def q_description_gaps(spark, base):
    return reports.description_gaps(_lv(spark, base)).select("doc_id", "brand", "description", "gap_reason")


def q_parse_report_time(spark, base):
    e = _events(spark, base).select("event_id", TF.format_time("ts").alias("report_time_text"))
    return e.withColumn("report_time", TF.parse_report_time("report_time_text"))


def q_report_time_formats(spark, base):
    e = _events(spark, base)
    return e.select("event_id", TF.format_time("ts", TF.REPORT_TIME).alias("report_time"),
                    TF.format_time("ts", TF.FILE_DATE).alias("file_date"),
                    TF.format_time("ts", TF.MAIL_DATE).alias("mail_date"),
                    TF.format_time("ts", TF.SHEET_TIME).alias("sheet_time"))


def q_elapsed_minutes(spark, base):
    return reports.elapsed_by(_events(spark, base), "user_id", ts="ts")


def _history_rows(e: DataFrame) -> DataFrame:
    return e.select(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("sku"),
                    F.floor("value").alias("stock"), F.col("props").alias("location"),
                    TF.format_time("ts", TF.SHEET_TIME).alias("report_time"))


def q_history_union(spark, base):
    e = _events(spark, base)
    cut = F.lit(HISTORY_CUTOFF).cast("timestamp_ntz")
    new = _history_rows(e.filter(F.col("ts") >= cut))
    old = history.as_text(_history_rows(e.filter(F.col("ts") < cut)))
    return history.union_with_history(new, old)


def q_append_by_name(spark, base):
    p = _part(spark, base)
    a = p.filter(F.col("p_size") < 25).select("p_partkey", "p_name", "p_brand")
    b = p.filter(F.col("p_size") >= 25).select("p_retailprice", "p_name", "p_partkey")
    return listings.append_by_name(a, b)


CUSTOMER_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                  "c_acctbal": "double", "c_mktsegment": "string"}


def q_history_as_text(spark, base):
    text = history.as_text(read_table(spark, base, "customer"))
    return history.typed(text, CUSTOMER_TYPES)


def q_null_to_empty(spark, base):
    d = read_table(spark, base, "documents").select("doc_id", "source")
    lab = read_table(spark, base, "labels")
    j = d.join(lab, "doc_id", "left")
    return history.null_to_empty(j.select("doc_id", "source", "quality", "toxic"), ["source", "quality", "toxic"])


def q_brand_url(spark, base):
    brands = _part(spark, base).select(F.col("p_brand").alias("brand")).distinct()
    return brand_urls(brands, SEARCH_BASE)


def q_stride_chunks(spark, base):
    p = _part(spark, base).select("p_partkey", "p_name")
    return listings.stride_chunks(p, "p_partkey", STRIDE)


def q_run_summary_sql(spark, base):
    return reports.run_summary_sql(_lv(spark, base), N_BRANDS)


def q_summary_headings(spark, base):
    return reports.with_display_headings(reports.run_summary(V.listing_facts_view(spark, base), N_BRANDS))


def q_brand_rollup(spark, base):
    r = reports.brand_rollup(V.listing_facts_view(spark, base))
    return r.withColumn("span_seconds", TF.span_seconds("first_time", "last_time"))


def q_stock_text(spark, base):
    t = V.bag_texts(spark, base)
    return t.select("l_orderkey", "l_linenumber", TX.first_token("bag_text").alias("stock"))


def q_preview_top5(spark, base):
    return reports.preview(_lv(spark, base), ["doc_id"], 5)


def q_layout_shapes(spark, base):
    return V.shaped_pages(spark, base).select("page_id", extract.layout_section("html").alias("section"))


def q_banner_shapes(spark, base):
    return V.shaped_pages(spark, base).select("page_id", H.first_text("html", *extract.BANNER).alias("banner_text"))


def q_heading_shapes(spark, base):
    return V.shaped_pages(spark, base).select(
        "page_id", extract.fallback(H.tag_text("html", "h2"), H.tag_text("html", "h1")).alias("heading"))


def q_card_shapes(spark, base):
    return extract.parse_cards(V.shaped_pages(spark, base), ("div", "ad"))


def q_card_shapes_regex(spark, base):
    return extract.class_cards(V.shaped_pages(spark, base), "div", "ad")


def q_card_at_position(spark, base):
    pos = (F.pmod("page_id", F.lit(9)) + 1).cast("int")
    return _pages(spark, base).select("page_id", extract.nth(V.nav_links_array(), pos).alias("card_text"))


def q_listings_built(spark, base):
    cards = daily.search_cards(V.composed_pages(spark, base, daily.SEARCH_CARD[1]))
    return listings.build_listings(cards, V.page_descriptions(spark, base), V.page_observations(spark, base),
                                   V.FAILED_MARKER)


def q_listings_summary(spark, base):
    return reports.run_summary(q_listings_built(spark, base), N_BRANDS)


def q_catalogue_rows(spark, base):
    head = f'<span class="big {catalogue.CATALOGUE_LOCATION}">North\nSide</span>'
    pages = V.composed_pages(spark, base, catalogue.CATALOGUE_CARD[1], head)
    return catalogue.catalogue_rows(pages, V.page_observations(spark, base), CATALOGUE_PORTFOLIO)


def q_card_shapes_any_tag(spark, base):
    return extract.parse_cards(V.shaped_pages(spark, base), extract.BANNER, {"inner": (None, None)})


def q_description_by_path(spark, base):
    found = extract.locate(V.path_pages(spark, base), {"sku": V.PATH_NAME, "description": V.PATH_DESCRIPTION})
    return found.withColumn("description", extract.with_default("description", V.FAILED_MARKER))


def q_portfolio_of_parts(spark, base):
    brands = _part(spark, base).select(F.expr("substr(p_name, 2, 2 + p_size % 3)").alias("brand"))
    return relevance.portfolio_semi_join(V.nav_cards(spark, base).drop("href"), brands, sku="card_text")


def q_global_position(spark, base):
    cards = V.nav_cards(spark, base).select(F.pmod("page_id", F.lit(STRIDE)).alias("chunk"), "page_id", "pos_in_pg", "card_text")
    # only the keys are sorted and written; the text meets its number afterwards
    placed = position.numbered(cards.drop("card_text"), ["chunk", "page_id", "pos_in_pg"])
    return cards.join(placed.drop("chunk"), ["page_id", "pos_in_pg"]).select("chunk", "page_id", "pos_in_pg", "card_text", "position")


def q_capture_time_asof(spark, base):
    landed = F.expr("timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, cast(page_id * 37 % 40000 as int))")
    pages = _pages(spark, base).select("page_id", F.pmod("page_id", F.lit(64)).alias("user_id"), landed.alias("landed_at"))
    visits = _events(spark, base).select("user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("visited_at"))
    return asof.asof_join(pages, visits, ["user_id"], "landed_at", "visited_at", ["visited_at", "event_id"])


def q_range_summary(spark, base):
    facts = V.listing_facts_view(spark, base).withColumn("report_date", F.to_date("report_time"))
    state = reports.brand_rollup(facts, ["report_date"])
    days = state.filter(F.col("report_date").between(*[F.lit(d).cast("date") for d in RANGE_DAYS]))
    return reports.summary_of(reports.merge_rollups(days), N_BRANDS)


def q_brands_seen_bitmap(spark, base):
    facts = V.listing_facts_view(spark, base).withColumn("report_date", F.to_date("report_time"))
    brands = position.numbered(facts.select("brand").filter(F.col("brand").isNotNull()).distinct(), ["brand"], "ord")
    state = reports.brand_bitmaps(facts, brands, ["report_date"])
    return reports.brands_in(state.filter(F.col("report_date").between(*[F.lit(d).cast("date") for d in RANGE_DAYS])))


def q_cards_table_function(spark, base):
    tables.register(spark)
    return spark.sql("select * from page_cards(TABLE(select page_id, html from {pages}), 'li', 'link_text=a')",
                     pages=_pages(spark, base))


def q_price_parse_sql(spark, base):
    sql_functions.register(spark)
    return spark.sql("""select l_orderkey, l_linenumber, price_text, money(price_text) as price,
                               money(discounted_price_text) as price_if_discounted from {t}""", t=V.price_texts(spark, base))


def q_spread_chunks(spark, base):
    dealt = listings.spread(_part(spark, base).select("p_partkey"), "p_partkey", STRIDE)
    return dealt.groupBy("chunk", F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


QUERIES: dict[str, Query] = {
    "capture_time_asof": q_capture_time_asof,
    "range_summary": q_range_summary,
    "brands_seen_bitmap": q_brands_seen_bitmap,
    "cards_table_function": q_cards_table_function,
    "price_parse_sql": q_price_parse_sql,
    "spread_chunks": q_spread_chunks,
    "card_shapes_any_tag": q_card_shapes_any_tag,
    "description_by_path": q_description_by_path,
    "portfolio_of_parts": q_portfolio_of_parts,
    "global_position": q_global_position,
    "layout_shapes": q_layout_shapes,
    "banner_shapes": q_banner_shapes,
    "heading_shapes": q_heading_shapes,
    "card_shapes": q_card_shapes,
    "card_shapes_regex": q_card_shapes_regex,
    "card_at_position": q_card_at_position,
    "listings_built": q_listings_built,
    "listings_summary": q_listings_summary,
    "catalogue_rows": q_catalogue_rows,
    "run_summary": q_run_summary,
    "stock_counts": q_stock_counts,
    "brands_missing": q_brands_missing,
    "undescribed_count": q_undescribed_count,
    "time_bounds": q_time_bounds,
    "brand_span": q_brand_span,
    "slowest_brand": q_slowest_brand,
    "slowest_brand_daily": q_slowest_brand_daily,
    "row_count": q_row_count,
    "cards_explode": q_cards_explode,
    "cards_by_class": q_cards_by_class,
    "cards_by_class_regex": q_cards_by_class_regex,
    "cards_by_tag": q_cards_by_tag,
    "first_text_by_class": q_first_text_by_class,
    "cards_per_page": q_cards_per_page,
    "page_position": q_page_position,
    "nth_card": q_nth_card,
    "layout_switch": q_layout_switch,
    "fallback_extract": q_fallback_extract,
    "page_attr_on_cards": q_page_attr_on_cards,
    "attach_by_position": q_attach_by_position,
    "price_parse": q_price_parse,
    "units_parse": q_units_parse,
    "quantity_strip": q_quantity_strip,
    "text_one_line": q_text_one_line,
    "desc_default": q_desc_default,
    "row_label": q_row_label,
    "brand_prefix_filter": q_brand_prefix_filter,
    "brand_prefix_join": q_brand_prefix_join,
    "portfolio_flag": q_portfolio_flag,
    "portfolio_semi_join": q_portfolio_semi_join,
    "stock_known": q_stock_known,
    "stock_from_observations": q_stock_from_observations,
    "replenish_list": q_replenish_list,
    "description_gaps": q_description_gaps,
    "parse_report_time": q_parse_report_time,
    "report_time_formats": q_report_time_formats,
    "elapsed_minutes": q_elapsed_minutes,
    "history_union": q_history_union,
    "append_by_name": q_append_by_name,
    "history_as_text": q_history_as_text,
    "null_to_empty": q_null_to_empty,
    "brand_url": q_brand_url,
    "stride_chunks": q_stride_chunks,
    "preview_top5": q_preview_top5,
    "run_summary_sql": q_run_summary_sql,
    "summary_headings": q_summary_headings,
    "brand_rollup": q_brand_rollup,
    "stock_text": q_stock_text,
}


# ---------------------------------------------------------------------------
# DuckDB oracle SQL (written independently of the Spark code above)
# ---------------------------------------------------------------------------

_LV = """
with lv as (
  select d.doc_id, d.text as sku, d.source as brand, l.quality as stock,
         case when l.toxic = 1 then 'ERROR'
              when l.quality is null and d.n_chars % 2 = 0 then null
              when d.n_chars % 11 = 0 then ''
              else d.text end as description,
         date_trunc('second', e.ts) as report_time
  from documents d
  left join labels l on l.doc_id = d.doc_id
  left join events e on e.event_id = d.doc_id)
"""

_SPAN = "\"right\"(cast(age({hi}, {lo}) as varchar), 8)"

_NAV = "'<li><a href=\"([^\"]*)\">([^<]*)</a></li>'"

_WS = r"'[\s\x{00A0}]+'"


def _tok(expr: str, n: int) -> str:
    return (f"nullif(list_extract(regexp_split_to_array(regexp_replace({expr}, '^' || {_WS}, ''), "
            f"{_WS}), {n}), '')")


def _money_sql(expr: str) -> str:
    t = f"replace({_tok(expr, 2)}, ',', '')"
    return (f"case when regexp_matches({t}, '^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
            f"then try_cast({t} as double) end")


def _units_sql(expr: str) -> str:
    t = f"replace({_tok(expr, 1)}, ',', '')"
    return f"case when regexp_matches({t}, '^[+-]?[0-9]+$') then try_cast({t} as bigint) end"


def _amount_sql(amount: str) -> str:
    return f"format('{{:,}}', cast(floor({amount}) as bigint)) || '.' || lpad(cast(l_linenumber as varchar), 2, '0')"


def _price_shape_sql(v: str, amount: str) -> str:
    a = _amount_sql(amount)
    return (f"case when {v} = 0 then 'Tk ' || {a} || ' each' when {v} = 1 then '  Tk ' || {a} "
            f"when {v} = 2 then 'Tk' || chr(160) || {a} when {v} = 3 then 'Sold out' when {v} = 4 then 'Tk' "
            f"when {v} = 5 then 'Tk ' || cast(cast(floor(l_quantity) as bigint) as varchar) || 'd' "
            f"when {v} = 6 then 'Tk 1_' || lpad(cast(l_linenumber as varchar), 3, '0') end")


_PRICES = f"""
with t as (
  select l_orderkey, l_linenumber,
    {_price_shape_sql('((l_orderkey * 7 + l_linenumber) % 8)', 'l_extendedprice')} as price_text,
    {_price_shape_sql('(((l_orderkey * 7 + l_linenumber) % 8 + 3) % 8)', 'l_extendedprice * (1.0 - l_discount)')}
      as discounted_price_text
  from lineitem)
"""

_BAGS = """
with t as (
  select l_orderkey, l_linenumber,
    case (l_orderkey + l_linenumber) % 6
      when 0 then format('{:,}', cast(l_quantity * 100 as bigint)) || ' in bag'
      when 1 then '  ' || cast(cast(l_quantity * 100 as bigint) as varchar) || ' in bag'
      when 2 then 'add to bag'
      when 3 then cast(cast(l_quantity * 100 as bigint) as varchar) || '.5 in bag'
      when 4 then '' end as bag_text
  from lineitem)
"""

_OBS = """
with obs as (
  select user_id, event_id as step,
         case when event_type in ('view', 'purchase') then cast(floor(value) as bigint) end as parsed,
         event_type = 'purchase' or event_type = 'signup' as is_stop,
         event_type = 'error' as fail, date_trunc('second', ts) as seen
  from events),
stops as (select user_id, min(step) filter (where is_stop) as s from obs group by user_id)
"""


def _history_rows_sql(where: str) -> str:
    return (f"select event_type || ' ' || cast(user_id as varchar) as sku, "
            f"cast(cast(floor(value) as bigint) as varchar) as stock, props as location, "
            f"strftime(ts, '%d-%b-%y, %I:%M %p') as report_time from events where {where}")


ORACLE_SQL: dict[str, str] = {
    "run_summary": _LV + f"""
, per as (
  select brand, count(sku) as skus, count(case when stock = 0 then sku end) as oos,
         count(case when stock is null then sku end) as failed,
         count(case when length(description) = 0 then sku end) as undesc,
         min(report_time) as lo, max(report_time) as hi
  from lv group by brand),
top as (
  select brand, {_SPAN.format(hi='hi', lo='lo')} as span_text from per
  order by 2 desc nulls last, brand asc nulls last limit 1)
select 'shop' as platform, t1.*, top.brand as longest_stock_to_scrape,
       top.span_text as longest_time_to_scrape_stock
from (select count(sku) as skus,
             count(case when stock = 0 then sku end) as skus_out_of_stock,
             count(case when stock is null then sku end) as skus_failed_stock,
             30 - count(distinct brand) as brands_failed_stock,
             count(case when length(description) = 0 then sku end) as skus_not_described,
             min(report_time) as stocking_start_time,
             {_SPAN.format(hi='max(report_time)', lo='min(report_time)')} as time_to_scrape_stocks
      from lv) t1, top
""",
    "stock_counts": _LV + """
select count(sku) as skus, count(case when stock = 0 then sku end) as skus_out_of_stock,
       count(case when stock is null then sku end) as skus_failed_stock from lv""",
    "brands_missing": _LV + "select 30 - count(distinct brand) as brands_failed_stock from lv",
    "undescribed_count": _LV + "select count(case when length(description) = 0 then sku end) as skus_not_described from lv",
    "time_bounds": f"""
select min(date_trunc('second', ts)) as stocking_start_time, max(date_trunc('second', ts)) as stocking_end_time,
       date_diff('second', min(date_trunc('second', ts)), max(date_trunc('second', ts))) as span_seconds,
       {_SPAN.format(hi="max(date_trunc('second', ts))", lo="min(date_trunc('second', ts))")} as time_to_scrape_stocks
from events""",
    "brand_span": f"""
select user_id, min(date_trunc('second', ts)) as first_time, max(date_trunc('second', ts)) as last_time,
       date_diff('second', min(date_trunc('second', ts)), max(date_trunc('second', ts))) as span_seconds,
       {_SPAN.format(hi="max(date_trunc('second', ts))", lo="min(date_trunc('second', ts))")} as span_text
from events group by user_id""",
    "slowest_brand": _LV + f"""
select brand, date_diff('second', min(report_time), max(report_time)) as span_seconds,
       {_SPAN.format(hi='max(report_time)', lo='min(report_time)')} as span_text
from lv group by brand order by span_seconds desc nulls last, brand asc nulls last limit 1""",
    "slowest_brand_daily": f"""
with per as (
  select cast(date_trunc('second', ts) as date) as report_date, user_id,
         min(date_trunc('second', ts)) as lo, max(date_trunc('second', ts)) as hi
  from events group by 1, 2),
r as (select *, row_number() over (partition by report_date
                                   order by date_diff('second', lo, hi) desc, user_id asc) as rn from per)
select report_date, user_id, date_diff('second', lo, hi) as span_seconds,
       {_SPAN.format(hi='hi', lo='lo')} as span_text
from r where rn = 1""",
    "row_count": _LV + "select count(*) as rows from lv",
    "cards_explode": f"""
select page_id, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg, unnest(h) as href, unnest(t) as card_text
from (select page_id, regexp_extract_all(html, {_NAV}, 1) as h, regexp_extract_all(html, {_NAV}, 2) as t from pages)
where len(t) > 0""",
    "cards_by_class": """
select page_id, cast(generate_subscripts(a, 1) as bigint) as pos_in_pg, unnest(a) as card_text
from (select page_id, regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1) as a from pages)
where len(a) > 0""",
    "cards_by_class_regex": """
select page_id, cast(generate_subscripts(a, 1) as bigint) as pos_in_pg, unnest(a) as card_text
from (select page_id, regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1) as a from pages)
where len(a) > 0""",
    "cards_by_tag": f"""
select page_id, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg, unnest(t) as card_text,
       unnest(t) as link_text
from (select page_id, regexp_extract_all(html, {_NAV}, 2) as t from pages)
where len(t) > 0""",
    "first_text_by_class": """
select page_id,
       case when regexp_matches(html, '<div class="ad">') then regexp_extract(html, '<div class="ad">([^<]*)', 1) end
         as ad_text,
       case when regexp_matches(html, 'class="[^"]*important-banner')
            then regexp_extract(html, 'class="[^"]*important-banner[^"]*"[^>]*>([^<]*)', 1) end as banner_text
from pages""",
    "cards_per_page": f"select page_id, cast(len(regexp_extract_all(html, {_NAV}, 2)) as bigint) as n_cards from pages",
    "page_position": f"""
select page_id, cast(row_number() over (partition by page_id order by ord) as bigint) as pos_in_pg, card_text
from (select page_id, generate_subscripts(t, 1) as ord, unnest(t) as card_text
      from (select page_id, regexp_extract_all(html, {_NAV}, 2) as t from pages))""",
    "nth_card": f"select page_id, regexp_extract_all(html, {_NAV}, 2)[{NTH}] as card_text from pages",
    "layout_switch": """
select page_id, case when regexp_matches(html, 'class="([^"]*\\s)?important-banner(\\s[^"]*)?"') then 3 else 2 end
  as section from pages""",
    "fallback_extract": """
select page_id,
  replace(replace(replace(replace(replace(coalesce(
      case when regexp_matches(html, '<h2[ >]') then regexp_extract(html, '<h2[^>]*>([^<]*)', 1) end,
      case when regexp_matches(html, '<h1[ >]') then regexp_extract(html, '<h1[^>]*>([^<]*)', 1) end),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') as heading
from pages""",
    "page_attr_on_cards": f"""
select page_id, location, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg, unnest(t) as card_text
from (select page_id, regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) as location,
             regexp_extract_all(html, {_NAV}, 2) as t from pages)
where len(t) > 0""",
    "attach_by_position": f"""
select page_id, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg, unnest(t) as card_text, unnest(h) as href
from (select page_id, regexp_extract_all(html, {_NAV}, 1) as h, regexp_extract_all(html, {_NAV}, 2) as t from pages)
where len(t) > 0""",
    "price_parse": _PRICES + f"""
select l_orderkey, l_linenumber, price_text, {_money_sql('price_text')} as price,
       {_money_sql('discounted_price_text')} as price_if_discounted from t""",
    "units_parse": _BAGS + f"select l_orderkey, l_linenumber, bag_text, {_units_sql('bag_text')} as units from t",
    "quantity_strip": "select p_partkey, replace(p_name, ' ', '') as quantity from part",
    "text_one_line": "select doc_id, replace(text, chr(10), ' ') as description from documents",
    "desc_default": _LV + "select doc_id, coalesce(description, 'ERROR') as description from lv",
    "row_label": """
select d.doc_id, coalesce(d.source, 'None') || ' ' || coalesce(cast(l.quality as varchar), 'None') as label
from documents d left join labels l on l.doc_id = d.doc_id""",
    "brand_prefix_filter": "select p_partkey, p_name as sku, 'Red' as brand from part where p_name ilike 'Red%'",
    "brand_prefix_join": """
select p.p_partkey, p.p_name as sku, b.brand
from part p join (values ('Red'), ('Small'), ('Hot')) b(brand) on p.p_name ilike b.brand || '%'""",
    "portfolio_flag": """
select p_partkey, p_name as sku,
       cast(contains(p_name, 'ring') or contains(p_name, 'gear') or contains(p_name, 'rod') as integer) as in_portfolio
from part""",
    "portfolio_semi_join": """
select p_partkey, p_name as sku from part p
where exists (select 1 from (values ('ring'), ('gear'), ('rod')) b(brand) where contains(p.p_name, b.brand))""",
    "stock_known": _LV + "select * from lv where stock is not null",
    "stock_from_observations": _OBS + """
select o.user_id,
       case when bool_or(o.fail) then null
            else coalesce(arg_max(o.parsed, o.step) filter (where o.parsed is not null), 0) end as stock,
       coalesce(arg_min(o.seen, o.step) filter (where o.is_stop or o.fail), max_by(o.seen, o.step)) as seen_at
from obs o join stops s on s.user_id = o.user_id
where s.s is null or o.step <= s.s
group by o.user_id""",
    "replenish_list": _LV + "select * from lv where stock = 0",
    "description_gaps": _LV + """
select doc_id, brand, description,
       case when description is null then 'missing' when description = 'ERROR' then 'failed' else 'empty' end
         as gap_reason
from lv where description is null or description = 'ERROR' or length(description) = 0""",
    "parse_report_time": """
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as report_time_text,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as report_time from events""",
    "report_time_formats": """
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as report_time, strftime(ts, '%Y-%m-%d') as file_date,
       strftime(ts, '%d-%b-%y') as mail_date, strftime(ts, '%d-%b-%y, %I:%M %p') as sheet_time from events""",
    "elapsed_minutes": """
select user_id, date_diff('second', min(date_trunc('second', ts)), max(date_trunc('second', ts))) as span_seconds,
       round(date_diff('second', min(date_trunc('second', ts)), max(date_trunc('second', ts))) / 60.0, 2)
         as elapsed_minutes
from events group by user_id""",
    "history_union": _history_rows_sql(f"ts >= timestamp '{HISTORY_CUTOFF}'") + " union all "
    + _history_rows_sql(f"ts < timestamp '{HISTORY_CUTOFF}'"),
    "append_by_name": """
select p_partkey, p_name, p_brand from part where p_size < 25
union all by name
select p_retailprice, p_name, p_partkey from part where p_size >= 25""",
    "history_as_text": """
select try_cast(cast(c_custkey as varchar) as bigint) as c_custkey, cast(c_name as varchar) as c_name,
       try_cast(cast(c_nationkey as varchar) as integer) as c_nationkey,
       try_cast(cast(c_acctbal as varchar) as double) as c_acctbal, cast(c_mktsegment as varchar) as c_mktsegment
from customer""",
    "null_to_empty": """
select d.doc_id, coalesce(d.source, '') as source, coalesce(cast(l.quality as varchar), '') as quality,
       coalesce(cast(l.toxic as varchar), '') as toxic
from documents d left join labels l on l.doc_id = d.doc_id""",
    "brand_url": f"""
select brand, '{SEARCH_BASE}' || brand as url, '{SEARCH_BASE}' || url_encode(brand) as url_encoded
from (select distinct p_brand as brand from part)""",
    "stride_chunks": f"""
select p_partkey, p_name, cast(p_partkey % {STRIDE} as integer) as chunk,
       cast(p_partkey // {STRIDE} as bigint) as pos_in_chunk from part""",
    "preview_top5": _LV + "select * from lv order by doc_id limit 5",
    "brand_rollup": _LV + """
select brand, count(sku) as skus, count(case when stock = 0 then sku end) as skus_out_of_stock,
       count(case when stock is null then sku end) as skus_failed_stock,
       count(case when length(description) = 0 then sku end) as skus_not_described,
       min(report_time) as first_time, max(report_time) as last_time,
       date_diff('second', min(report_time), max(report_time)) as span_seconds
from lv group by brand""",
    "stock_text": _BAGS + f"select l_orderkey, l_linenumber, {_tok('bag_text', 1)} as stock from t",
}

_HEADING_ENTITIES = """replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
      '&#39;', ''''), '&amp;', '&')"""

_FLOW = f"""
with links as (
  select page_id, captured_at, brand, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg,
         translate(unnest(t), '&', '+') as sku
  from (select page_id, timestamp '2024-03-01 00:00:00' + to_minutes(page_id) as captured_at,
               case page_id % 4 when 0 then 'E' when 1 then 't' when 2 then 'o' end as brand,
               regexp_extract_all(html, {_NAV}, 2) as t from pages)
  where len(t) > 0),
obs as (
  select user_id as page_id, event_id % 6 + 1 as pos_in_pg, event_id as step,
         case when event_type in ('view', 'purchase') then cast(floor(value) as bigint) end as parsed,
         event_type = 'purchase' or event_type = 'signup' as is_stop,
         event_type = 'error' as fail, date_trunc('second', ts) as seen
  from events),
stops as (select page_id, pos_in_pg, min(step) filter (where is_stop) as s from obs group by 1, 2),
folded as (
  select o.page_id, o.pos_in_pg,
         case when bool_or(o.fail) then null
              else coalesce(arg_max(o.parsed, o.step) filter (where o.parsed is not null), 0) end as stock,
         coalesce(arg_min(o.seen, o.step) filter (where o.is_stop or o.fail), max_by(o.seen, o.step)) as seen_at
  from obs o join stops s on s.page_id = o.page_id and s.pos_in_pg = o.pos_in_pg
  where s.s is null or o.step <= s.s
  group by 1, 2),
described as (
  select doc_id // 5 as page_id, doc_id % 5 + 1 as pos_in_pg, max(text) as description from documents group by 1, 2),
built as (
  select l.sku, l.brand, cast(l.pos_in_pg as varchar) || ' kg' as quantity,
         cast(l.page_id * 100 + l.pos_in_pg as double) + 0.5 as price,
         case when l.pos_in_pg % 2 = 1 then cast(l.pos_in_pg as double) end as price_if_discounted, l.pos_in_pg,
         f.stock, coalesce(replace(d.description, chr(10), ' '), 'ERROR') as description,
         coalesce(f.seen_at, l.captured_at) as report_time, l.page_id
  from links l left join folded f on f.page_id = l.page_id and f.pos_in_pg = l.pos_in_pg
  left join described d on d.page_id = l.page_id and d.pos_in_pg = l.pos_in_pg
  where l.sku ilike l.brand || '%')
"""

ORACLE_SQL |= {
    "layout_shapes": """
select page_id, case when page_id % 6 in (0, 4) or html like '%important-banner%' then 3 else 2 end as section
from pages""",
    "banner_shapes": """
select page_id, case page_id % 6 when 0 then 'Sale & more' when 4 then 'Now' end as banner_text from pages""",
    "heading_shapes": f"""
select page_id, case page_id % 6 when 1 then 'Top' || chr(160) || chr(233) when 2 then 'Second <1>'
  else {_HEADING_ENTITIES.format("case when regexp_matches(html, '<h1[ >]') then regexp_extract(html, '<h1[^>]*>([^<]*)', 1) end")}
  end as heading
from pages""",
    "card_at_position": f"""
select page_id, regexp_extract_all(html, {_NAV}, 2)[page_id % 9 + 1] as card_text from pages""",
    "listings_built": _FLOW + "select * from built",
    "listings_summary": _FLOW + f"""
, per as (select brand, min(report_time) as lo, max(report_time) as hi from built group by brand),
top as (
  select brand, {_SPAN.format(hi='hi', lo='lo')} as span_text, date_diff('second', lo, hi) as secs from per
  order by 2 desc nulls last, brand asc nulls last limit 1)
select 'shop' as platform, t1.*, top.brand as longest_stock_to_scrape, top.span_text as longest_time_to_scrape_stock
from (select count(sku) as skus, count(case when stock = 0 then sku end) as skus_out_of_stock,
             count(case when stock is null then sku end) as skus_failed_stock,
             30 - count(distinct brand) as brands_failed_stock,
             count(case when length(description) = 0 then sku end) as skus_not_described,
             min(report_time) as stocking_start_time,
             {_SPAN.format(hi='max(report_time)', lo='min(report_time)')} as time_to_scrape_stocks
      from built) t1, top""",
    "catalogue_rows": _FLOW + """
select l.sku || ' ' || cast(l.pos_in_pg as varchar) || 'kg' as sku, cast(f.stock as varchar) as stock,
       'North Side' as location, strftime(l.captured_at, '%d-%b-%y, %I:%M %p') as report_time,
       cast(l.captured_at as date) as report_date
from links l join folded f on f.page_id = l.page_id and f.pos_in_pg = l.pos_in_pg
where f.stock is not null and (contains(l.sku, 'th') or contains(l.sku, 'en'))""",
}
ORACLE_SQL["card_shapes"] = """
select page_id, cast(generate_subscripts(a, 1) as bigint) as pos_in_pg, unnest(a) as card_text
from (select page_id, list_concat(case page_id % 6 when 3 then ['quoted'] when 4 then ['bare'] else [] end,
                                  regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1)) as a from pages)
where len(a) > 0"""
ORACLE_SQL["card_shapes_any_tag"] = """
select page_id, cast(1 as bigint) as pos_in_pg, case page_id % 6 when 0 then 'Sale & more' else 'Now' end as card_text,
       cast(null as varchar) as inner
from pages where page_id % 6 in (0, 4)"""
ORACLE_SQL["description_by_path"] = f"""
select page_id, pos_in_pg, t as sku, case when (page_id + pos_in_pg) % 3 = 2 then 'ERROR' else 'On ' || t end as description
from (select page_id, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg, translate(unnest(t), '&', '+') as t
      from (select page_id, regexp_extract_all(html, {_NAV}, 2) as t from pages))"""
ORACLE_SQL["portfolio_of_parts"] = f"""
with b as (select distinct substr(p_name, 2, 2 + p_size % 3) as brand from part)
select page_id, pos_in_pg, card_text
from (select page_id, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg, unnest(t) as card_text
      from (select page_id, regexp_extract_all(html, {_NAV}, 2) as t from pages)) c
where exists (select 1 from b where contains(c.card_text, b.brand))"""
ORACLE_SQL["global_position"] = f"""
select page_id % 3 as chunk, page_id, pos_in_pg, card_text,
       row_number() over (order by page_id % 3, page_id, pos_in_pg) as position
from (select page_id, cast(generate_subscripts(t, 1) as bigint) as pos_in_pg, unnest(t) as card_text
      from (select page_id, regexp_extract_all(html, {_NAV}, 2) as t from pages))"""
ORACLE_SQL["capture_time_asof"] = """
select p.page_id, p.user_id, p.landed_at, e.ts as visited_at, e.event_id
from (select page_id, page_id % 64 as user_id,
             timestamp '2024-01-02 00:00:00' + to_minutes(page_id * 37 % 40000) as landed_at from pages) p
asof left join events e on p.user_id = e.user_id and e.ts <= p.landed_at"""
ORACLE_SQL["range_summary"] = ORACLE_SQL["run_summary"].replace(_LV, _LV.replace("with lv as", "with lv0 as") + f"""
, lv as (select * from lv0 where cast(report_time as date) between date '{RANGE_DAYS[0]}' and date '{RANGE_DAYS[1]}')
""")
ORACLE_SQL["brands_seen_bitmap"] = _LV + f"""
select cast(count(distinct brand) as bigint) as brands_seen from lv
where cast(report_time as date) between date '{RANGE_DAYS[0]}' and date '{RANGE_DAYS[1]}'"""
ORACLE_SQL["cards_table_function"] = ORACLE_SQL["cards_by_tag"]
ORACLE_SQL["price_parse_sql"] = ORACLE_SQL["price_parse"]
ORACLE_SQL["spread_chunks"] = """
select cast(p_partkey % 3 as integer) as chunk, cast(p_partkey % 3 as integer) as partition, count(*) as rows
from part group by 1, 2"""
ORACLE_SQL["card_shapes_regex"] = ORACLE_SQL["card_shapes"]
ORACLE_SQL["run_summary_sql"] = ORACLE_SQL["run_summary"]
ORACLE_SQL["summary_headings"] = """
select platform, skus as "SKUs", skus_out_of_stock as "SKUs out of stock",
       skus_failed_stock as "SKUs failed to scrape stock", brands_failed_stock as "brands failed to scrape stock",
       skus_not_described as "SKUs not described", stocking_start_time as "stocking start time",
       time_to_scrape_stocks as "time to scrape stocks", longest_stock_to_scrape as "longest stock to scrape",
       longest_time_to_scrape_stock as "longest time to scrape stock"
from (""" + ORACLE_SQL["run_summary"] + ") q"
