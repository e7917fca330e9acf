"""Page-to-rows extraction: cards, fields, positions, layout choice, fallbacks.

Every operator here is narrow (no shuffle): a landed page becomes its card
rows inside the task that scanned it. Position in page comes from
``posexplode`` (1-based ``pos_in_pg``), never from a global window.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H

# The page parser runs inside Python tasks: ship its module (and this one) by value
# with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(H)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ColumnOrName = Column | str

# Fixed value: the element (of any tag) whose presence shifts the page layout by one section.
BANNER = (None, "important-banner")

# Rows, and characters in them, after which a task hands on what it has parsed.
PIECE_ROWS = 4096
PIECE_CHARS = 1 << 24


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_cards(pages: DataFrame, pattern: str, groups: dict[str, int], html: str = "html",
                keep: Iterable[str] = ("page_id",)) -> DataFrame:
    """One row per regex match of ``pattern`` in ``html`` (flat markup).

    ``groups`` maps output column -> capture group. Output: ``keep`` columns,
    ``pos_in_pg`` (BIGINT, 1-based document order) and one column per group.
    Pages without a match give no rows.
    """
    keep = list(keep)
    names = list(groups)
    if len(names) == 1:
        g = groups[names[0]]
        exploded = pages.select(*keep, F.posexplode(
            F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(g))).alias("pos", names[0]))
        return exploded.select(*keep, (F.col("pos") + 1).cast("bigint").alias("pos_in_pg"), names[0])
    # one pass over the page collects whole matches; the groups come from the short match texts
    exploded = pages.select(*keep, F.posexplode(
        F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))).alias("pos", "__match"))
    return exploded.select(*keep, (F.col("pos") + 1).cast("bigint").alias("pos_in_pg"),
                           *[F.regexp_extract("__match", pattern, g).alias(n) for n, g in groups.items()])


def class_cards(pages: DataFrame, tag: str | None, token: str, html: str = "html",
                keep: Iterable[str] = ("page_id",), decode: bool = True) -> DataFrame:
    """Flat ``tag.token`` elements (any tag, if None) as rows: ``keep``, ``pos_in_pg``, ``card_text``."""
    out = regex_cards(pages.withColumn(html, H.visible(html)), H.class_pattern(tag, token) + r"([^<]*)",
                      {"card_text": 1}, html, keep)
    return out.withColumn("card_text", H.decode_basic("card_text")) if decode else out


def _in_pieces(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of at most ``PIECE_ROWS`` rows and about ``PIECE_CHARS`` characters, also within a page."""
    def frame(held: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(names, map(list, zip(*held, strict=True)), strict=True)))

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= PIECE_ROWS or chars >= PIECE_CHARS:
            yield frame(held)
            held, chars = [], 0
    if held:
        yield frame(held)


def parse_cards(pages: DataFrame, card: tuple[str | None, str | None],
                fields: dict[str, tuple[str | None, str | None]] | None = None, html: str = "html",
                keep: Iterable[str] = ("page_id",), card_text: bool = True) -> DataFrame:
    """Cards of nested markup with a real parser (``mapInPandas``, one page at a time).

    ``card`` and fields are ``(tag, class token)``; None as tag selects by class alone, as token
    by tag alone. Output: ``keep`` columns, ``pos_in_pg`` (BIGINT, 1-based), ``card_text``
    (with ``card_text=False`` it is never put together) and one STRING column per
    field (NULL when the card has no such descendant). Put native filters on ``pages`` before calling: Catalyst does
    not push predicates through a Python stage. Pages whose HTML does not even
    contain the card's class token cannot hold a card and are dropped by a
    JVM-side filter before any Python runs.
    """
    keep = list(keep)
    card = (card[0] and card[0].lower(), card[1])
    fields = {n: (tag and tag.lower(), token) for n, (tag, token) in (fields or {}).items()}
    texts = [*(["card_text"] if card_text else []), *fields]
    in_schema = pages.select(*keep).schema
    out_schema = T.StructType(
        list(in_schema.fields)
        + [T.StructField("pos_in_pg", T.LongType(), False)]
        + [T.StructField(n, T.StringType()) for n in texts])

    def rows(pdf: pd.DataFrame) -> Iterator[tuple]:
        kept = list(zip(*(pdf[k].tolist() for k in keep), strict=True)) if keep else [()] * len(pdf)
        for own, page_html in zip(kept, pdf["page_html"].tolist(), strict=True):
            for pos, c in enumerate(H.card_rows(page_html, card, fields, card_text), 1):
                yield *own, pos, *(c[n] for n in texts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from _in_pieces(rows(pdf), out_schema.names)

    # never drops a page the parser would match: tags in any case; a class may be written with character references
    if card[1] is not None:
        maybe = F.col(html).contains(F.lit(card[1])) | F.col(html).contains(F.lit("&"))
    elif card[0] is not None:
        maybe = F.lower(html).contains(F.lit("<" + card[0]))
    else:
        maybe = F.col(html).isNotNull()
    return pages.filter(maybe).select(*keep, F.col(html).alias("page_html")).mapInPandas(run, out_schema)


def locate(pages: DataFrame, fields: dict[str, str | list[str]], section: Column | None = None, html: str = "html",
           keep: Iterable[str] = ("page_id",)) -> DataFrame:
    """Texts of elements found by their place in the page (X8, X9, X10 together).

    ``fields`` maps a column to a path or to several, of which the first that hits gives the
    text (see ``functions.html.element_path``; ``$section`` is the page's ``section``, the layout number
    by default). Paths with ``$pos`` give one row per page and position that any field hits:
    ``keep``, ``pos_in_pg``, the fields, NULL where none of a field's paths hits at that position. Without ``$pos``
    a page is one row, also when nothing hits. Narrow: no shuffle.
    """
    keep = list(keep)
    paths = {n: [H.element_path(p) for p in ([v] if isinstance(v, str) else v)] for n, v in fields.items()}
    by_pos = {any(n == H.POS for _, n in steps) for of in paths.values() for _, steps in of}
    if len(by_pos) != 1:
        raise ValueError(f"all paths or none must have {H.POS}")
    by_pos = by_pos.pop()
    out_schema = T.StructType(
        list(pages.select(*keep).schema.fields)
        + ([T.StructField("pos_in_pg", T.LongType(), False)] if by_pos else [])
        + [T.StructField(n, T.StringType()) for n in paths])

    def texts(page_html: str | None, layout: int) -> Iterator[tuple]:
        if page_html is None:
            yield from () if by_pos else [(None,) * len(paths)]
            return
        table = H.ElementTable(page_html)
        found = []
        for of in paths.values():
            hit: dict[int, int] = {}
            for path in of:
                hit = table.by_path(path, layout) | hit          # an earlier path wins
            found.append(hit)
        for pos in sorted(set().union(*found)) if by_pos else [0]:
            yield *([pos] if by_pos else []), *(table.text_of(hit.get(pos)) for hit in found)

    def rows(pdf: pd.DataFrame) -> Iterator[tuple]:
        kept = list(zip(*(pdf[k].tolist() for k in keep), strict=True)) if keep else [()] * len(pdf)
        for own, page_html, layout in zip(kept, pdf["page_html"].tolist(), pdf["page_section"].tolist(), strict=True):
            for found in texts(page_html, layout):
                yield *own, *found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from _in_pieces(rows(pdf), out_schema.names)

    number = layout_section(html) if section is None else section
    return pages.select(*keep, F.col(html).alias("page_html"), number.cast("int").alias("page_section")) \
        .mapInPandas(run, out_schema)


def card_count(cards_array: ColumnOrName) -> Column:
    """Number of cards in a page's card array, BIGINT."""
    return F.size(_col(cards_array)).cast("bigint")


def nth(cards_array: ColumnOrName, pos: int | ColumnOrName) -> Column:
    """1-based positional access into a page's cards; NULL past the end."""
    p = F.lit(pos) if isinstance(pos, int) else _col(pos)
    return F.try_element_at(_col(cards_array), p)


def layout_section(html: ColumnOrName, banner: tuple[str | None, str] = BANNER,
                   with_banner: int = 3, without_banner: int = 2) -> Column:
    """Layout choice by page: section index when a banner element is present, else the default."""
    return F.when(H.has_class(html, *banner), F.lit(with_banner)).otherwise(F.lit(without_banner))


def fallback(*candidates: ColumnOrName) -> Column:
    """First locator that finds something (``coalesce`` of extractions, in order)."""
    return F.coalesce(*[_col(c) for c in candidates])


def with_default(c: ColumnOrName, marker: str | None) -> Column:
    """Value with a failure marker (``None`` or e.g. ``'ERROR'``) where collection failed."""
    return F.coalesce(_col(c), F.lit(marker).cast("string"))


def position_in_page(df: DataFrame, page: str = "page_id", order: str = "ord",
                     out: str = "pos_in_pg") -> DataFrame:
    """1-based position by page when no position came with the rows.

    Window partitions are one page each (bounded by the cards of a page).
    """
    w = Window.partitionBy(page).orderBy(order)
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))
