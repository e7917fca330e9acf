"""The text and time functions for SQL users.

``register`` defines them as SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``),
whose bodies the optimizer puts in place: a query that calls them has the plan of
the Column form, with no Python in it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import text as TX
from . import timefmt as TF


def _quoted(s: str) -> str:
    """A raw SQL string literal (no escapes read); none of ours holds a double quote."""
    if '"' in s:
        raise ValueError(s)
    return f'r"{s}"'


def _number(shape: str, n: int, to: str) -> str:
    src, dst = TX._decimal_digits()
    digits = f"if(octet_length(c) = length(c), c, translate(c, {_quoted(src)}, {_quoted(dst)}))"
    token = f"nullif(regexp_extract({digits}, {_quoted(TX.nth_token_pattern(n, shape))}, 1), '')"
    return f"try_cast(replace({token}, ',', '') AS {to})"


def _second_of_day(t: str) -> str:
    return f"hour({t}) * 3600 + minute({t}) * 60 + second({t})"


def definitions() -> dict[str, str]:
    """Function name -> the SQL that defines it."""
    time = _quoted(TF.REPORT_TIME)
    return {
        "money": f"money(c STRING) RETURNS DOUBLE RETURN {_number(TX.DECIMAL_WITH_COMMAS, 2, 'DOUBLE')}",
        "units": f"units(c STRING) RETURNS BIGINT RETURN {_number(TX.INTEGER_WITH_COMMAS, 1, 'BIGINT')}",
        "first_token": "first_token(c STRING) RETURNS STRING RETURN "
                       f"nullif(regexp_extract(c, {_quoted(TX.nth_token_pattern(1))}, 1), '')",
        "strip_spaces": "strip_spaces(c STRING) RETURNS STRING RETURN replace(c, ' ', '')",
        "one_line": "one_line(c STRING) RETURNS STRING RETURN replace(c, char(10), ' ')",
        "span_seconds": "span_seconds(a TIMESTAMP_NTZ, b TIMESTAMP_NTZ) RETURNS BIGINT RETURN "
                        f"CAST(datediff(to_date(b), to_date(a)) AS BIGINT) * {TF.SECONDS_PER_DAY} "
                        f"+ CAST({_second_of_day('b')} - ({_second_of_day('a')}) AS BIGINT)",
        "span_text": "span_text(s BIGINT) RETURNS STRING RETURN format_string('%02d:%02d:%02d', "
                     f"pmod(s, {TF.SECONDS_PER_DAY}) div 3600, pmod(pmod(s, {TF.SECONDS_PER_DAY}), 3600) div 60, "
                     f"pmod(pmod(s, {TF.SECONDS_PER_DAY}), 60))",
        "report_time": "report_time(c STRING) RETURNS TIMESTAMP_NTZ RETURN "
                       f"CASE WHEN try_to_timestamp(c, {time}) IS NOT NULL THEN to_timestamp_ntz(c, {time}) END",
        "report_time_text": f"report_time_text(t TIMESTAMP_NTZ) RETURNS STRING RETURN date_format(t, {time})",
    }


def register(spark: SparkSession) -> list[str]:
    """Define the functions in the session; returns their names."""
    found = definitions()
    for body in found.values():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
    return list(found)
