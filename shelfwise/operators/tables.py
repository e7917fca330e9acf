"""Card extraction as a table function for SQL users.

    SELECT * FROM page_cards(TABLE(SELECT page_id, html FROM pages), 'div.ad', 'name=div.name, price=.price')

A selector is ``tag.token``: a tag, a class token, or both. The result has the
table's columns but ``html``, then ``pos_in_pg``, ``card_text`` and one column per
field; its schema comes from the arguments.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions import html as H

cloudpickle.register_pickle_by_value(H)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGE_COLUMN = "html"


def selector(text: str) -> tuple[str | None, str | None]:
    tag, _, token = text.strip().partition(".")
    if not (tag or token):
        raise ValueError(f"a selector is tag, .token or tag.token: {text!r}")
    return tag.lower() or None, token or None


def field_selectors(text: str) -> dict[str, tuple[str | None, str | None]]:
    fields = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, equals, sel = part.partition("=")
        if not equals or not name.strip():
            raise ValueError(f"a field is name=selector: {part!r}")
        fields[name.strip()] = selector(sel)
    return fields


class PageCards:
    @staticmethod
    def analyze(pages: AnalyzeArgument, card: AnalyzeArgument, fields: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not pages.isTable or PAGE_COLUMN not in pages.dataType.names:
            raise ValueError(f"the first argument is a table with a column {PAGE_COLUMN}")
        selector(card.value)
        names = field_selectors(fields.value) if fields is not None and fields.value else {}
        return AnalyzeResult(T.StructType(
            [f for f in pages.dataType.fields if f.name != PAGE_COLUMN]
            + [T.StructField("pos_in_pg", T.LongType()), T.StructField("card_text", T.StringType())]
            + [T.StructField(n, T.StringType()) for n in names]))

    def eval(self, pages: Row, card: str, fields: str | None = None) -> Iterator[tuple]:
        names = field_selectors(fields) if fields else {}
        own = tuple(pages[c] for c in pages.__fields__ if c != PAGE_COLUMN)
        for pos, c in enumerate(H.card_rows(pages[PAGE_COLUMN], selector(card), names), 1):
            yield *own, pos, c["card_text"], *(c[n] for n in names)


def register(spark: SparkSession, name: str = "page_cards") -> None:
    """Make the table function known to the session's SQL."""
    spark.udtf.register(name, udtf(PageCards))
