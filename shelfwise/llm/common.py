"""Shared helpers of the training-data operators: shared-folder tables, row
identity, text columns, Arrow slicing.

Lineage is cut with Parquet tables written under ``spark.checkpoint.dir`` (the
folder all executors share). Only a local session without that setting gets a
folder of its own; on a cluster the missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows handled at a time inside an Arrow batch: bounds the Python objects alive.
SLICE_ROWS = 512


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only for a local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    configured = tempfile.mkdtemp(prefix="shelfwise-llm-")
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the recovery point of a job."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z only (``lower`` would also fold other scripts)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Identity of a row's result: its id and a hash of its text.

    Rows that agree on both have equal results, so repeated rows may share one
    computation; rows that repeat an id with another text stay apart.
    """
    return [F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__h")]


def same_key(a: DataFrame, b: DataFrame) -> Column:
    return a["__id"].eqNullSafe(b["__id"]) & (a["__h"] == b["__h"])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An outer column named inside a higher-order function may be computed anew for each
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def utf8(values: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, NULL as empty."""
    return [b"" if v is None else v for v in values.cast(pa.binary()).to_pylist()]


def hash_fraction(c: Column, seed: int = 0) -> Column:
    """A fixed pseudo-random number in [0, 1) of a value (NULL hashes to the seed)."""
    return (F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
