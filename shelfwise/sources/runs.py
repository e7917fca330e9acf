"""Tables made of runs: a run is written aside, then switched in.

``<table>/data/<key>=<run>/batch=<id>`` holds what one attempt of a run wrote; it
is never changed. ``<table>/commits`` is a log of one-row files, written after the
data: (run, batch, seq, rows, committed_at). The appearance of that one file is
the switch. Readers take each run's entry of the largest ``seq``, so

* a rerun replaces its own run and no other, also when it is empty;
* an attempt that fails, at whatever moment, leaves every run as it was;
* a reader that planned before the switch keeps reading the files it planned.

Nothing is deleted here: replaced batches stay until ``replaced`` lists them to
whoever cleans up.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "run string, batch string, seq bigint, rows bigint, committed_at timestamp_ntz"
RUN_NAME = re.compile(r"[A-Za-z0-9_][A-Za-z0-9._-]*")


def _root(path: str) -> str:
    return path.rstrip("/")


def _log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(COMMITS).parquet(f"{_root(path)}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch, seq, rows, committed_at): the batch that stands for each run."""
    last = Window.partitionBy("run").orderBy(F.desc("seq"), F.desc("committed_at"), F.desc("batch"))
    return _log(spark, path).withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")


def replaced(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch): batches that no reader planning from now on will read."""
    log = _log(spark, path)
    return log.join(committed(spark, path), ["run", "batch"], "left_anti").select("run", "batch")


def stage(df: DataFrame, path: str, run: str, key: str = "run", partition_by: Iterable[str] = (), fmt: str = "parquet",
          options: dict[str, str] | None = None) -> str:
    """Write an attempt of a run aside and return its batch; no reader sees it yet."""
    if not RUN_NAME.fullmatch(run):
        raise ValueError(f"a run is named by letters, digits, '.', '_' and '-': {run!r}")
    batch = uuid.uuid4().hex
    df.write.format(fmt).options(**(options or {})).partitionBy(*partition_by) \
        .save(f"{_root(path)}/data/{key}={run}/batch={batch}")
    return batch


def switch(spark: SparkSession, path: str, run: str, batch: str, rows: int) -> None:
    """Make a staged batch the run's."""
    seq = _log(spark, path).filter(F.col("run") == run).agg(F.max("seq")).first()[0] or 0
    spark.range(1).select(F.lit(run).alias("run"), F.lit(batch).alias("batch"), F.lit(seq + 1).cast("bigint").alias("seq"),
                          F.lit(rows).cast("bigint").alias("rows"), F.localtimestamp().alias("committed_at")) \
        .coalesce(1).write.mode("append").parquet(f"{_root(path)}/commits")


def _folders(spark: SparkSession, path: str, key: str, runs: Iterable[str] | None) -> list[str]:
    found = committed(spark, path)
    if runs is not None:
        found = found.filter(F.col("run").isin(*runs))
    # one short row per run of the table
    return [f"{_root(path)}/data/{key}={r['run']}/batch={r['batch']}" for r in found.orderBy("run").collect()]


def write_run(df: DataFrame, path: str, run: str, key: str = "run", partition_by: Iterable[str] = (),
              fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Write a run's rows, replacing what an earlier attempt of the same run wrote."""
    spark = df.sparkSession
    batch = stage(df, path, run, key, partition_by, fmt, options)
    back = spark.read.format(fmt).options(**(options or {})).schema(df.schema)
    rows = back.load(f"{_root(path)}/data/{key}={run}/batch={batch}").count()
    switch(spark, path, run, batch, rows)


def read_runs(spark: SparkSession, path: str, schema: T.StructType, runs: Iterable[str] | None = None, key: str = "run",
              fmt: str = "parquet", options: dict[str, str] | None = None) -> DataFrame:
    """The rows of the committed runs (all, or those named), with the declared ``schema``.

    A schema that has the column ``key`` gets the run's name in it. Only the runs'
    folders are listed and read; a table without runs is empty.
    """
    folders = _folders(spark, path, key, runs)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).options(**(options or {})).option("basePath", f"{_root(path)}/data").schema(schema) \
        .load(folders).select(*schema.names)
