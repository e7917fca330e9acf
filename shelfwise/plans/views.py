"""Listing-shaped views over the test-data tables.

The landed tables of a real deployment (pages, cards, observations, listings)
are stood in for by the driver's tables:

* ``listing_view``: documents ⟕ labels ⟕ events, one listing per document:
  ``sku`` = text, ``brand`` = source, ``stock`` = label quality (NULL = failed,
  0 = out of stock), ``description`` = ``'ERROR'`` for toxic documents, NULL
  for unlabelled documents of even length, ``''`` for lengths divisible by 11,
  else the text; ``report_time`` = the event with the document's id, to the
  second.
* ``nav_cards``: the navigation links of ``pages`` as cards.
* ``price_texts`` / ``bag_texts``: price and bag-counter text composed from
  lineitem numbers, with the malformed shapes the parsers must reject.
* ``event_observations``: events as add-to-bag observations per user.

All three joins of the listing view are on the document id, so documents are
shuffled once and both joins share that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import timefmt as TF
from ..operators import extract
from ..sources.tables import read_table

# The navigation-link card of the test pages.
NAV_LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'
FAILED_MARKER = "ERROR"


def _description_kind(quality: Column, toxic: Column, n_chars: Column) -> Column:
    return (F.when(toxic == 1, F.lit("failed"))
            .when(quality.isNull() & (F.pmod(n_chars, F.lit(2)) == 0), F.lit("missing"))
            .when(F.pmod(n_chars, F.lit(11)) == 0, F.lit("empty"))
            .otherwise(F.lit("text")))


def _joined(spark: SparkSession, base: str, doc_cols: list[Column]) -> DataFrame:
    d = read_table(spark, base, "documents").select("doc_id", F.col("source").alias("brand"), "n_chars", *doc_cols)
    lab = read_table(spark, base, "labels").select("doc_id", "quality", "toxic")
    ev = read_table(spark, base, "events").select(F.col("event_id").alias("doc_id"), "ts")
    j = d.join(lab, "doc_id", "left").join(ev, "doc_id", "left")
    return j.withColumn("desc_kind", _description_kind(F.col("quality"), F.col("toxic"), F.col("n_chars")))


def listing_view(spark: SparkSession, base: str) -> DataFrame:
    """doc_id, sku, brand, stock, description, report_time."""
    j = _joined(spark, base, [F.col("text")])
    description = (F.when(F.col("desc_kind") == "failed", F.lit(FAILED_MARKER))
                   .when(F.col("desc_kind") == "missing", F.lit(None).cast("string"))
                   .when(F.col("desc_kind") == "empty", F.lit(""))
                   .otherwise(F.col("text")))
    return j.select("doc_id", F.col("text").alias("sku"), "brand", F.col("quality").cast("int").alias("stock"),
                    description.alias("description"), TF.to_seconds_ntz("ts").alias("report_time"))


def listing_facts_view(spark: SparkSession, base: str) -> DataFrame:
    """``reports.listing_facts(listing_view(...))`` (up to sub-second report times, which
    the reports drop) without moving any text through the joins.

    Presence and length of the text are computed in the documents scan task;
    only flags and numbers are shuffled.
    """
    j = _joined(spark, base, [F.col("text").isNotNull().alias("sku_present"),
                              F.length("text").cast("bigint").alias("text_len")])
    desc_len = (F.when(F.col("desc_kind") == "failed", F.lit(len(FAILED_MARKER)).cast("bigint"))
                .when(F.col("desc_kind") == "missing", F.lit(None).cast("bigint"))
                .when(F.col("desc_kind") == "empty", F.lit(0).cast("bigint"))
                .otherwise(F.col("text_len")))
    # report times stay raw: the reports truncate after aggregating
    return j.select("brand", "sku_present", F.col("quality").cast("int").alias("stock"),
                    desc_len.alias("desc_len"), F.col("ts").alias("report_time"))


def nav_cards(spark: SparkSession, base: str, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """page_id, pos_in_pg, href, card_text: the navigation links of each page."""
    pages = read_table(spark, base, "pages")
    return extract.regex_cards(pages, NAV_LINK, {"href": 1, "card_text": 2}, keep=keep)


def nav_links_array(html: str = "html", group: int = 2) -> Column:
    return F.regexp_extract_all(F.col(html), F.lit(NAV_LINK), F.lit(group))


def _variant(n: int) -> Column:
    return F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(n))


def _amount_text(amount: Column) -> Column:
    return F.concat(F.format_number(F.floor(amount), 0), F.lit("."),
                    F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))


def _price_shape(v: Column, amount: Column) -> Column:
    a = _amount_text(amount)
    return (F.when(v == 0, F.concat(F.lit("Tk "), a, F.lit(" each")))
            .when(v == 1, F.concat(F.lit("  Tk "), a))
            .when(v == 2, F.concat(F.lit("Tk "), a))
            .when(v == 3, F.lit("Sold out"))
            .when(v == 4, F.lit("Tk"))
            .when(v == 5, F.concat(F.lit("Tk "), F.floor("l_quantity").cast("string"), F.lit("d")))
            .when(v == 6, F.concat(F.lit("Tk 1_"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"))))


def price_texts(spark: SparkSession, base: str) -> DataFrame:
    """l_orderkey, l_linenumber, price_text, discounted_price_text (8 shapes each, one NULL)."""
    li = read_table(spark, base, "lineitem")
    disc = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber",
                     _price_shape(_variant(8), F.col("l_extendedprice")).alias("price_text"),
                     _price_shape(F.pmod(_variant(8) + 3, F.lit(8)), disc).alias("discounted_price_text"))


def bag_texts(spark: SparkSession, base: str) -> DataFrame:
    """l_orderkey, l_linenumber, bag_text (6 shapes, one NULL)."""
    li = read_table(spark, base, "lineitem")
    q = (F.col("l_quantity") * 100).cast("bigint")
    v = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(6))
    shape = (F.when(v == 0, F.concat(F.format_number(q, 0), F.lit(" in bag")))
             .when(v == 1, F.concat(F.lit("  "), q.cast("string"), F.lit(" in bag")))
             .when(v == 2, F.lit("add to bag"))
             .when(v == 3, F.concat(q.cast("string"), F.lit(".5 in bag")))
             .when(v == 4, F.lit("")))
    return li.select("l_orderkey", "l_linenumber", shape.alias("bag_text"))


def event_observations(spark: SparkSession, base: str) -> DataFrame:
    """Events as add-to-bag observations: key user_id, step event_id.

    view / purchase show a count in the bag (the value, floored); purchase also
    shows the limit marker; signup means the bag counter is gone; error is a
    failed step; click shows no count.
    """
    ev = read_table(spark, base, "events")
    counted = F.col("event_type").isin("view", "purchase")
    bag = F.when(counted, F.concat(F.format_number(F.floor("value"), 0), F.lit(" in bag"))) \
        .otherwise(F.lit("add to bag"))
    return ev.select("user_id", F.col("event_id").alias("step"), bag.alias("bag_text"),
                     (F.col("event_type") == "purchase").alias("limit_marker"),
                     (F.col("event_type") != "signup").alias("counter_present"),
                     (F.col("event_type") == "error").alias("failed"),
                     TF.to_seconds_ntz("ts").alias("observed_at"))


# Markup put in front of a test page, by page id modulo their number.
PAGE_SHAPES = [
    '<section class="wide important-banner">Sale &amp; more</section>',
    '<!-- <div class="important-banner">old</div> --><h2 class="t">Top&nbsp;&#233;</h2>',
    '<script>var s = \'<div class="important-banner">\';</script><h2>Second &lt;1&gt;</h2>',
    '<DIV data-class="important-banner" title="a > b">no</DIV><div title="a > b" class=\'x ad\'>quoted</div>',
    "<p class='important-banner'>Now</p><DIV CLASS=ad>bare</DIV>",
    "",
]


def shaped_pages(spark: SparkSession, base: str) -> DataFrame:
    """page_id, html: pages with banners of several tags, commented ones, second headings and other quotes."""
    shape = F.element_at(F.array(*[F.lit(s) for s in PAGE_SHAPES]),
                         (F.pmod("page_id", F.lit(len(PAGE_SHAPES))) + 1).cast("int"))
    return read_table(spark, base, "pages").select("page_id", F.concat(shape, "html").alias("html"))


# Paths to the name and the description of a card of ``path_pages``; the description has two places.
PATH_NAME = "#page/div[$section]/div[2]/div[$pos]/div/div[1]"
PATH_DESCRIPTION = ["#page/div[$section]/div[2]/div[$pos]/div/div[2]/span/a",
                    "#page/div[$section]/div[2]/div[$pos]/div/div[3]/span/a"]


def path_pages(spark: SparkSession, base: str) -> DataFrame:
    """page_id, html: pages whose cards are found by place only.

    The list of cards is the page's second section, the third where a banner puts a strip in front.
    A card's description (the link text, marked up) is in its second part, in the third
    behind a badge, or missing, by page and position.
    """
    def one(text: Column, i: Column) -> Column:
        name = F.translate(text, "&", "+")
        link = F.concat(F.lit("<div><p>x</p><span><a href='#'>On <b>"), name, F.lit("</b><br></a></span></div>"))
        kind = F.pmod(F.col("page_id") + i + 1, F.lit(3))
        rest = F.when(kind == 0, link).when(kind == 1, F.concat(F.lit("<div>new</div>"), link)) \
            .otherwise("<p><span><a>no</a></span></p>")
        return F.concat(F.lit("<div><div><div>"), name, F.lit("</div>"), rest, F.lit("</div></div>"))

    banner = F.pmod("page_id", F.lit(len(PAGE_SHAPES))).isin(
        [i for i, s in enumerate(PAGE_SHAPES) if "important-banner" in s and not s.startswith(("<!--", "<script", "<DIV"))])
    shape = F.element_at(F.array(*[F.lit(s) for s in PAGE_SHAPES]),
                         (F.pmod("page_id", F.lit(len(PAGE_SHAPES))) + 1).cast("int"))
    return read_table(spark, base, "pages").select("page_id", F.concat(
        shape, F.lit("<div id='page'><div>menu</div>"), F.when(banner, "<div>strip</div>").otherwise(""),
        F.lit("<section><div>no</div></section><div><div>filter</div><div>"),
        F.array_join(F.transform(nav_links_array(), one), ""), F.lit("</div></div></div>")).alias("html"))


def _div(token: str, *content: Column) -> Column:
    return F.concat(F.lit(f'<div class="{token}">'), *content, F.lit("</div>"))


def composed_pages(spark: SparkSession, base: str, card: str, head: str = "") -> DataFrame:
    """Landed pages whose cards are the navigation links of ``pages``.

    The name is the link text, the quantity the position, the price is made of
    page and position, odd positions have a discount; the brand is E, t, o or
    NULL by page; pages are captured a minute apart.
    """
    def one(text: Column, i: Column) -> Column:
        pos = (i + 1).cast("bigint")
        price = F.concat(F.lit("Tk "), F.format_number(F.col("page_id") * 100 + pos, 0), F.lit(".50"))
        return _div(card, _div("name", F.translate(text, "&", "+")), _div("subText", pos.cast("string"), F.lit(" kg")),
                    _div("price", price),
                    F.when(pos % 2 == 1, _div("discountedPrice", F.lit("Tk "), pos.cast("string"))).otherwise(""))

    brand = F.get(F.array(F.lit("E"), F.lit("t"), F.lit("o"), F.lit(None)), F.pmod("page_id", F.lit(4)).cast("int"))
    at = F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, 0, cast(page_id as int))")
    return read_table(spark, base, "pages").select(
        "page_id", brand.alias("brand"), F.lit(None).cast("string").alias("location"), at.alias("captured_at"),
        F.concat(F.lit(head), F.array_join(F.transform(nav_links_array(), one), "")).alias("html"))


def page_observations(spark: SparkSession, base: str) -> DataFrame:
    """Events as observations of page positions: the page is the user id, the position event id modulo 6, plus 1."""
    o = event_observations(spark, base)
    return o.select(F.col("user_id").cast("bigint").alias("page_id"),
                    (F.pmod("step", F.lit(6)) + 1).cast("bigint").alias("pos_in_pg"), *o.columns[1:])


def page_descriptions(spark: SparkSession, base: str) -> DataFrame:
    """Documents as fetched descriptions, five to a page."""
    return read_table(spark, base, "documents").select(
        F.expr("doc_id div 5").alias("page_id"), (F.pmod("doc_id", F.lit(5)) + 1).cast("bigint").alias("pos_in_pg"),
        F.col("text").alias("description"))


def page_location(html: str = "html") -> Column:
    """Page-level attribute carried onto every card (the page language here)."""
    return H.attr_value(html, "html", "lang")
