"""HTML helpers: class-token patterns for flat markup, an element table for nested markup.

Two forms of the same selection ("elements of tag T whose class attribute holds
token K, in document order"):

* ``class_pattern`` / ``first_text`` / ``all_texts``: Java regular expressions,
  evaluated JVM-side. Agree with the parser on flat markup (the element holds
  text only); not read: class names written with character references, named
  entities beyond the basic ones, text of ``template`` as hidden.
* ``ElementTable``: a ``html.parser`` handler used per page inside
  ``mapInPandas`` (see ``operators.extract.parse_cards`` and ``locate``). Exact for
  nested markup: class matching is by token, fields are the first matching
  descendant in document order, text is the decoded text of the subtree, elements
  are also found by their path.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Elements that never hold content, and elements whose text is
# not part of the visible text.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT_TAGS = frozenset(["script", "style", "template"])

# The basic entities decoded by the regex form (besides numeric references).
BASIC_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]
NUMERIC_REFERENCE = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

# What holds no elements: comments, and the raw text of scripts and styles.
NOT_MARKUP = r"(?is)<!--.*?-->|<(script|style)\b[^>]*+>.*?(?:</\1[^>]*+>|\z)"
# An attribute's value (quoted either way, or bare), and the rest of an opening tag: quoted values are stepped over.
VALUE = r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+"
REST_OF_TAG = r"(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def visible(html: ColumnOrName) -> Column:
    """The page without comments, scripts and styles: their text is no markup."""
    return F.regexp_replace(_col(html), NOT_MARKUP, "")


def _upto_attr(tag: str | None, attr: str) -> str:
    """Regex of an opening tag (any, if ``tag`` is None) up to the value of its first ``attr``."""
    name = r"[a-zA-Z][^\s/>]*+" if tag is None else rf"(?i:{re.escape(tag)})(?=[\s/])"
    a = re.escape(attr)
    return rf"<{name}(?:[\s/]++(?!(?i:{a})[\s=/>])[^\s\"'>/=]++{VALUE})*+[\s/]++(?i:{a})\s*+=\s*+"


def class_pattern(tag: str | None, token: str) -> str:
    """Regex for the opening tag of ``<tag class="... token ...">`` (token-aware); any tag, if None.

    Tag and attribute names match in any case, as in HTML; the class token is
    case-sensitive. Attributes are read one by one, so neither ``data-class`` nor
    text inside another value is taken for a class.
    """
    k = re.escape(token)
    return (_upto_attr(tag, "class") + rf"(?:\"(?:[^\"]*\s)?{k}(?:\s[^\"]*)?\"|'(?:[^']*\s)?{k}(?:\s[^']*)?'"
            rf"|{k}(?=[\s>])){REST_OF_TAG}")


def _character(ref: Column) -> Column:
    """The character of a numeric reference; an ampersand stays a reference, for the named entities' turn."""
    digits = F.regexp_replace(ref, "[^0-9a-fA-F]", "")
    hexed = F.when(F.lower(F.substring(ref, 3, 1)) == "x", digits).otherwise(F.conv(digits, 10, 16))
    code = F.conv(hexed, 16, 10).cast("bigint")
    known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(code == 38, "&amp;").when(known, F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")) \
        .otherwise("\ufffd")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _decoded(c: Column) -> Column:
    refs = F.regexp_extract_all(c, F.lit(NUMERIC_REFERENCE), F.lit(0))
    pieces = F.array_join(F.transform(F.split(c, NUMERIC_REFERENCE, -1), lambda piece, i: F.concat(
        piece, F.when(i < F.size(refs), _character(F.get(refs, i))).otherwise(""))), "")
    out = F.when(F.contains(c, F.lit("&#")), pieces).otherwise(c)
    for ent, ch in BASIC_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def decode_basic(c: ColumnOrName) -> Column:
    """Numeric references and the basic entities decoded."""
    return _let(_col(c), lambda t: F.when(F.contains(t, F.lit("&")), _decoded(t)).otherwise(t))


def has_class(html: ColumnOrName, tag: str | None, token: str) -> Column:
    return visible(html).rlike(class_pattern(tag, token))


def _first_match(html: ColumnOrName, opening: str, then: Callable[[Column], Column]) -> Column:
    """``then`` of the first opening tag and the text behind it, found in one pass over the page; NULL without one."""
    return _let(F.regexp_extract(visible(html), opening + r"[^<]*", 0), lambda m: F.when(m != "", then(m)))


def first_text(html: ColumnOrName, tag: str | None, token: str, decode: bool = True) -> Column:
    """Text of the first ``tag.token`` element (flat markup; any tag, if None); NULL when there is none."""
    p = class_pattern(tag, token)

    def text(m: Column) -> Column:
        t = F.regexp_extract(m, p + r"([^<]*)", 1)
        return decode_basic(t) if decode else t

    return _first_match(html, p, text)


def all_texts(html: ColumnOrName, tag: str | None, token: str) -> Column:
    """Array of the texts of all ``tag.token`` elements (flat markup), document order."""
    return F.regexp_extract_all(visible(html), F.lit(class_pattern(tag, token) + r"([^<]*)"), F.lit(1))


def tag_text(html: ColumnOrName, tag: str) -> Column:
    """Text of the first ``<tag>`` element (flat), NULL when absent."""
    p = rf"<(?i:{re.escape(tag)})(?=[\s/>]){REST_OF_TAG}"
    return _first_match(html, p, lambda m: decode_basic(F.regexp_extract(m, p + r"([^<]*)", 1)))


def attr_value(html: ColumnOrName, tag: str, attr: str) -> Column:
    """Value of ``attr`` on the first ``<tag>`` that has it, quoted either way or bare; NULL when absent."""
    written = F.regexp_extract(visible(html), _upto_attr(tag, attr) + r"(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return _let(written, lambda w: F.when(w != "", decode_basic(
        F.when(w.startswith('"') | w.startswith("'"), F.substring(w, F.lit(2), F.length(w) - 2)).otherwise(w))))


class ElementTable(HTMLParser):
    """One page as a table of its elements, in document order.

    Every element is an interval of the one text buffer and of the table itself:
    ``begin[i]:end[i]`` is its text, ``i + 1:last[i]`` its descendants. End tags
    close the innermost open element of that name, as the tree builders of common
    parsers do; void elements hold nothing; what is still open ends with the page.
    Reading a page takes time in proportion to its length, however deep it nests.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag: list[str] = []
        self.classes: list[str] = []                    # the class attribute as written
        self.parent: list[int] = []                     # -1 at the top
        self.depth: list[int] = []
        self.nth: list[int] = []                        # among its siblings of the same tag, from 1
        self.nth_any: list[int] = []                    # among all its siblings
        self.begin: list[int] = []
        self.end: list[int] = []
        self.last: list[int] = []
        self.by_id: dict[str, int] = {}                 # the first element of an id
        self._pieces: list[str] = []
        self._size = 0
        self._hidden = 0
        self._open: list[int] = []
        self._open_tags: dict[str, int] = {}            # open elements per tag name
        self._siblings: dict[tuple[int, str | None], int] = {}
        self.feed(html)
        self.close()
        for i in self._open:
            self._shut(i)
        self.text = "".join(self._pieces)

    def _shut(self, i: int) -> None:
        self.end[i], self.last[i] = self._size, len(self.tag)

    def _count(self, parent: int, tag: str | None) -> int:
        n = self._siblings.get((parent, tag), 0) + 1
        self._siblings[parent, tag] = n
        return n

    def handle_starttag(self, tag, attrs):
        i, parent = len(self.tag), self._open[-1] if self._open else -1
        first: dict[str, str] = {}
        for k, v in attrs:
            if k in ("class", "id") and k not in first:
                first[k] = v or ""
        self.tag.append(tag)
        self.classes.append(first.get("class", ""))
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.nth.append(self._count(parent, tag))
        self.nth_any.append(self._count(parent, None))
        self.begin.append(self._size)
        self.end.append(self._size)
        self.last.append(i + 1)
        if "id" in first:
            self.by_id.setdefault(first["id"], i)
        if tag not in VOID_TAGS:
            self._open.append(i)
            self._open_tags[tag] = self._open_tags.get(tag, 0) + 1
            self._hidden += tag in HIDDEN_TEXT_TAGS

    def handle_startendtag(self, tag, attrs):
        # <div class="x"/>: an element with no content
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self._open_tags.get(tag):
            return
        while True:
            i = self._open.pop()
            self._shut(i)
            self._open_tags[self.tag[i]] -= 1
            self._hidden -= self.tag[i] in HIDDEN_TEXT_TAGS
            if self.tag[i] == tag:
                return

    def handle_data(self, data):
        if not self._hidden:
            self._pieces.append(data)
            self._size += len(data)

    def unknown_decl(self, data):
        # <![CDATA[...]]> sections are text of the enclosing element
        if data.startswith("CDATA["):
            self.handle_data(data[len("CDATA["):])

    def text_of(self, i: int | None) -> str | None:
        return None if i is None else self.text[self.begin[i]:self.end[i]]

    def select(self, tag: str | None, token: str | None) -> list[int]:
        """Elements of a tag (any, if None) whose class attribute holds a token (any, if None)."""
        return [i for i, (t, c) in enumerate(zip(self.tag, self.classes, strict=True))
                if (tag is None or t == tag) and (token is None or token in c and token in c.split())]

    def by_path(self, path: Path, section: int | None = None) -> dict[int, int]:
        """First element at a path, per position: of the step ``[$pos]``, or 0 for a path without it."""
        anchor, steps = path
        root = -1 if anchor is None else self.by_id.get(anchor)
        found: dict[int, int] = {}
        if root is None:
            return found
        for i, tag in enumerate(self.tag):
            if steps[-1][0] not in (tag, "*") or self.depth[i] < len(steps) - 1:
                continue
            at, pos = i, 0
            for want, n in reversed(steps):
                if at < 0 or want not in (self.tag[at], "*"):
                    break
                nth = self.nth_any[at] if want == "*" else self.nth[at]
                if n == POS:
                    pos = nth
                elif n is not None and nth != (section if n == SECTION else n):
                    break
                at = self.parent[at]
            else:
                if at == root:
                    found.setdefault(pos, i)
        return found


# A path: the id its first step hangs from (None: the top of the page) and its steps, (tag, number or None).
Path = tuple[str | None, list[tuple[str, int | str | None]]]
POS, SECTION = "$pos", "$section"


def element_path(text: str) -> Path:
    """``#page/div/div[6]/section/div[$section]/div[2]/div[$pos]/span/a`` as steps.

    A step is a tag (``*``: any) with the number among its siblings of that tag; without a
    number every such child is followed. ``$pos`` takes every number and reports it,
    ``$section`` is the page's layout number.
    """
    steps = text.strip().split("/")
    anchor = steps.pop(0)
    if anchor and not anchor.startswith("#") or not steps:
        raise ValueError(f"a path begins with #id/ or /: {text!r}")
    out: list[tuple[str, int | str | None]] = []
    for s in steps:
        m = re.fullmatch(r"([a-zA-Z][\w-]*|\*)(?:\[([1-9][0-9]*|\$pos|\$section)\])?", s)
        if not m:
            raise ValueError(f"no step of a path: {s!r} in {text!r}")
        out.append((m[1].lower(), int(m[2]) if m[2] and m[2].isdigit() else m[2]))
    if sum(n == POS for _, n in out) > 1:
        raise ValueError(f"more than one {POS} in {text!r}")
    return anchor[1:] if anchor else None, out


def card_rows(html: str | None, card: tuple[str | None, str | None],
              fields: dict[str, tuple[str | None, str | None]], card_text: bool = True) -> Iterator[dict]:
    """Cards of one page, one at a time: ``card_text`` (if wanted) and the text of the first descendant per field.

    ``card`` and each field are ``(tag, class token)``, None for any. Matching cards may
    nest; every match is a card (document order of the opening tags).
    """
    if html is None:
        return
    table = ElementTable(html)
    found = {name: table.select(*sel) for name, sel in fields.items()}
    for i in table.select(*card):
        row = {"card_text": table.text_of(i)} if card_text else {}
        for name, at in found.items():
            k = bisect_right(at, i)
            row[name] = table.text_of(at[k]) if k < len(at) and at[k] < table.last[i] else None
        yield row


def collect_cards(html: str | None, card: tuple[str | None, str | None],
                  fields: dict[str, tuple[str | None, str | None]], card_text: bool = True) -> list[dict]:
    """Cards of one page as dicts (``card_text``, if wanted, plus one key per field)."""
    return list(card_rows(html, card, fields, card_text))
