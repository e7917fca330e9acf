"""Column expressions for listing text: tokens, money, unit counts, labels.

All functions take and return ``Column``s, so they stay inside whole-stage
codegen. Failures give NULL, never an error (ANSI mode is on in Spark 4, so
only ``try_*`` forms are used).
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Unicode-aware whitespace (Python's ``str.split()`` also splits
# on a no-break space; Java's plain ``\s`` does not) and the number shapes a
# parse accepts once commas are removed. ``nan``, ``inf`` and ``1_000`` are
# rejected on purpose.
DECIMAL_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"

# The same shapes with commas allowed anywhere (they are removed before the cast).
DECIMAL_WITH_COMMAS = (r",*[+-]?,*(?:[0-9][0-9,]*(?:\.[0-9,]*)?|\.,*[0-9][0-9,]*)"
                       r"(?:[eE],*[+-]?,*[0-9][0-9,]*)?")
INTEGER_WITH_COMMAS = r",*[+-]?,*[0-9][0-9,]*"


@lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    # rule: every non-ASCII character of Unicode category Nd, mapped to its decimal value
    # (Python's int() and float() read these digits; Spark's casts do not)
    src, dst = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.decimal(ch)))
    return "".join(src), "".join(dst)


def ascii_digits(c: "ColumnOrName") -> Column:
    """Decimal digits of any script as ASCII digits (pure ASCII text is passed through)."""
    x = _col(c)
    src, dst = _decimal_digits()          # built once, on first use
    return F.when(F.octet_length(x) == F.length(x), x).otherwise(F.translate(x, src, dst))


def nth_token_pattern(n: int, token: str = r"\S+") -> str:
    """Regex whose group 1 is the n-th whitespace token, only when it matches ``token`` whole."""
    return r"(?U)^\s*" + r"(?:\S+\s+)" * (n - 1) + f"({token})" + r"(?:\s|$)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token(c: ColumnOrName, n: int) -> Column:
    """n-th (1-based) whitespace-separated token, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(c), nth_token_pattern(n), 1), F.lit(""))


def _numeric_token(c: ColumnOrName, n: int, shape: str, to: str) -> Column:
    # one regex pass: the token is captured only when it is a number (commas anywhere),
    # so the cast never sees text it would read differently
    t = F.nullif(F.regexp_extract(ascii_digits(c), nth_token_pattern(n, shape), 1), F.lit(""))
    return F.replace(t, F.lit(","), F.lit("")).try_cast(to)


def money(c: ColumnOrName, n: int = 2) -> Column:
    """Price from text such as ``'<sign> 1,234.50'``: token n, commas removed, as DOUBLE."""
    return _numeric_token(c, n, DECIMAL_WITH_COMMAS, "double")


def units(c: ColumnOrName, n: int = 1) -> Column:
    """Unit count from text such as ``'1,200 in bag'``: token n, commas removed, as BIGINT."""
    return _numeric_token(c, n, INTEGER_WITH_COMMAS, "bigint")


def first_token(c: ColumnOrName) -> Column:
    """First whitespace token kept as text (the catalogue form of a stock reading)."""
    return token(c, 1)


def strip_spaces(c: ColumnOrName) -> Column:
    """Remove every U+0020 (only that character, as the catalogue quantity clean-up does)."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def one_line(c: ColumnOrName) -> Column:
    """Newline to space, for descriptions and page-level text."""
    return F.replace(_col(c), F.lit("\n"), F.lit(" "))


def as_text(c: ColumnOrName) -> Column:
    """Text form of a value where a missing value reads ``None``."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))


def row_label(sku: ColumnOrName, quantity: ColumnOrName) -> Column:
    """``'<sku> <quantity>'`` with missing parts written as ``None``."""
    return F.concat(as_text(sku), F.lit(" "), as_text(quantity))


def empty_if_null(c: ColumnOrName) -> Column:
    """NULL to ``''`` for text sinks that cannot hold NULL."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))
