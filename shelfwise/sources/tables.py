"""Parquet table access. Column pruning and predicate pushdown happen in the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Fixed value: tables of the test-data folder.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(base: str, name: str) -> str:
    return os.path.join(base, f"{name}.parquet") if "://" not in base else f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(base, name))
