"""Time expressions: report-time text, run spans and their ``HH:MM:SS`` text.

Times are zone-less local wall-clock values, kept as TIMESTAMP_NTZ and only
formatted at the sinks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The text formats of report times.
REPORT_TIME = "yyyy-MM-dd HH:mm:ss"      # per-row report time, CSV column
FILE_DATE = "yyyy-MM-dd"                 # dated CSV file name
MAIL_DATE = "dd-MMM-yy"                  # subject line date
SHEET_TIME = "dd-MMM-yy, hh:mm a"        # history sheet report time

SECONDS_PER_DAY = 86400


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_seconds_ntz(c: ColumnOrName) -> Column:
    """Truncate to whole seconds, as TIMESTAMP_NTZ, without passing through a time zone.

    (``date_trunc`` returns a zoned TIMESTAMP; casting back would move wall-clock
    times that fall in a daylight-saving gap of the session zone.)
    """
    t = _col(c)
    fraction = F.date_part(F.lit("SECOND"), t) - F.second(t)
    return (t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)).cast("timestamp_ntz")


def parse_report_time(c: ColumnOrName, fmt: str = REPORT_TIME) -> Column:
    """Report-time text to TIMESTAMP_NTZ; text that does not fit gives NULL.

    ``try_to_timestamp`` only checks the text (it would read it in the session
    zone); the value comes from the zone-free ``to_timestamp_ntz``.
    """
    return F.when(F.try_to_timestamp(_col(c), F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(_col(c), F.lit(fmt)))


def format_time(c: ColumnOrName, fmt: str = REPORT_TIME) -> Column:
    return F.date_format(_col(c), fmt)


def _second_of_day(t: Column) -> Column:
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def span_seconds(first: ColumnOrName, last: ColumnOrName) -> Column:
    """Whole seconds from ``first`` to ``last`` (both truncated to seconds), BIGINT.

    Wall-clock arithmetic on dates and times of day, so no session time zone
    (and none of its daylight-saving gaps) enters the result.
    """
    a, b = _col(first), _col(last)
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    return days * SECONDS_PER_DAY + (_second_of_day(b) - _second_of_day(a)).cast("bigint")


def span_text(seconds: ColumnOrName) -> Column:
    """``HH:MM:SS`` of a span with whole days dropped, as the run report prints it.

    Equal to ordering by seconds only for spans under a day; the report keeps it
    for parity and ``slowest_brand`` sorts on seconds instead.
    """
    s = F.pmod(_col(seconds), F.lit(SECONDS_PER_DAY))
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60),
                           F.pmod(s, F.lit(60)))


def span_rank_key(seconds: ColumnOrName) -> Column:
    """Integer whose descending order equals the descending order of ``span_text``."""
    return F.pmod(_col(seconds), F.lit(SECONDS_PER_DAY))


def elapsed_minutes(seconds: ColumnOrName) -> Column:
    """Minutes with two decimals, ``round(s / 60, 2)``."""
    return F.round(_col(seconds).cast("double") / F.lit(60.0), 2)
