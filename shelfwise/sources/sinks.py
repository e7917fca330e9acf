"""Writers: dated CSV export of a day's listings, and the listings table itself.

The Parquet listings table (a table of runs, one a day) is the primary
sink: it keeps NULL apart from ``''`` and lets later reads prune by day. The
CSV export is the hand-over file, written with the quoting of common
spreadsheet tools: a quote inside text is doubled, empty text and NULL are
both written as nothing.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timefmt as TF
from ..schemas import LISTINGS
from . import runs

DAY = "report_date"

# CSV options of the export.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "timestampNTZFormat": TF.REPORT_TIME,
    "lineSep": "\n",
}


def dated_name(prefix: str, day: dt.date | str) -> str:
    d = day if isinstance(day, str) else day.strftime("%Y-%m-%d")
    return f"{prefix}{d}.csv"


def write_dated_csv(df: DataFrame, folder: str, prefix: str, day: dt.date | str,
                    mode: str = "overwrite") -> str:
    """Write ``df`` as CSV to ``<folder>/<prefix><yyyy-MM-dd>.csv`` (a folder of part files)."""
    path = os.path.join(folder, dated_name(prefix, day)) if "://" not in folder \
        else f"{folder.rstrip('/')}/{dated_name(prefix, day)}"
    w = df.write.mode(mode)
    for k, v in CSV_OPTIONS.items():
        w = w.option(k, v)
    w.csv(path)
    return path


def read_csv_text(spark, path: str, columns: list[str]) -> DataFrame:
    """Read an export back with every value as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = spark.read.schema(schema).option("multiLine", "true")
    for k, v in CSV_OPTIONS.items():
        if k != "timestampNTZFormat":
            r = r.option(k, v)
    return r.csv(path)


def write_listings(listings: DataFrame, path: str, day: dt.date | str) -> None:
    """Write a run's rows as the run day's, whatever their report times.

    A rerun replaces exactly that day, also when it is empty; all rows of the run
    are in it and other days are untouched. Until the new rows are whole, and if
    writing them fails, the day's old rows stand (``sources.runs``).
    """
    runs.write_run(listings.drop(DAY), path, str(day), key=DAY)


def read_listings(spark, path: str, day: dt.date | str | None = None) -> DataFrame:
    """The listings table, or one day of it (only that day's files are listed and read).

    Read with the declared schema, so a table written from an empty run reads
    as empty instead of failing schema inference.
    """
    return runs.read_runs(spark, path, LISTINGS, None if day is None else [str(day)], key=DAY)
