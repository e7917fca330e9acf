"""The stock history table: text form (as a sheet holds it), typed form, appends.

A sheet gives every value as text, NULL as ``''``. New rows are put in front
of the history by position (``UNION ALL``, no de-duplication); both sides are
cast to text first, since a typed union of a number and free text fails under
ANSI mode. The history is a table of runs (``sources.runs``) partitioned by report date,
never rewritten in place; the sheet form is written from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..functions import timefmt as TF
from . import runs

# Fixed value: columns of the history sheet, in order.
HISTORY_COLUMNS = ["sku", "stock", "location", "report_time"]

SHEET_RUN = "sheet"
SHEET_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to STRING (names kept)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns back to types; text that does not fit gives NULL."""
    return df.select(*[(F.col(c).try_cast(types[c]) if types.get(c, "string") != "string" else F.col(c)).alias(c)
                       for c in df.columns])


def union_with_history(new: DataFrame, history: DataFrame) -> DataFrame:
    """New rows, then history rows, matched by position, all as text."""
    n = as_text(new)
    h = as_text(history).toDF(*n.columns)
    return n.unionAll(h)


def null_to_empty(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL to ``''`` in the given columns (cast to text first), others kept."""
    cols = set(cols if cols is not None else df.columns)
    return df.select(*[(TX.empty_if_null(c) if c in cols else F.col(c)).alias(c) for c in df.columns])


def typed_history(text: DataFrame) -> DataFrame:
    """Typed copies of the sheet columns: ``stock_n`` BIGINT and ``report_ts`` TIMESTAMP_NTZ."""
    return text.withColumn("stock_n", TX.units("stock")) \
        .withColumn("report_ts", TF.parse_report_time(F.col("report_time"), TF.SHEET_TIME))


def read_history_csv(spark: SparkSession, path: str, columns: Sequence[str] = HISTORY_COLUMNS) -> DataFrame:
    """Read a sheet export: header row, every value as text, no schema inference."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(path)


def append_history(rows: DataFrame, path: str, date_col: str = "report_date", run: str | None = None) -> None:
    """Append a run's rows to the history table (Parquet, partitioned by report date).

    A ``run`` written again replaces its own earlier rows and no others; without a
    name every call is a run of its own. A failure leaves the history as it was.
    """
    runs.write_run(rows, path, run or uuid.uuid4().hex, partition_by=[date_col])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history table (text columns plus ``report_date``), read with its declared schema."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in HISTORY_COLUMNS]
                          + [T.StructField("report_date", T.DateType())])
    return runs.read_runs(spark, path, schema)


def sheet(history: DataFrame) -> DataFrame:
    """The history as the sheet holds it: its four columns as text, NULL as ``''``, the newest rows in front."""
    by = [F.col("report_date").desc_nulls_last(), "sku", "stock", "location", "report_time"]
    return null_to_empty(history.orderBy(*by).select(*HISTORY_COLUMNS))


def write_sheet(history: DataFrame, path: str) -> None:
    """Write the sheet form (CSV with a header, as one run that the next sheet replaces).

    Readers have the old sheet until the new one is whole: it is never cleared first.
    """
    runs.write_run(sheet(history), path, SHEET_RUN, fmt="csv", options=SHEET_OPTIONS)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The current sheet, every value as text, ``''`` where the history has NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in HISTORY_COLUMNS])
    return null_to_empty(runs.read_runs(spark, path, schema, [SHEET_RUN], fmt="csv", options=SHEET_OPTIONS))
