"""Landed pages: the input of every run.

Fetching pages is not part of this library: a crawler lands the rendered HTML
of each search or catalogue page, and these readers turn it into the
``landed_pages`` table (page_id, url, brand, location, captured_at, html).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANDED_PAGES


def brand_urls(brands: DataFrame, base: str, brand: str = "brand") -> DataFrame:
    """Search address per brand: ``base + brand`` as written, and URL-encoded."""
    b = F.col(brand)
    return brands.select(b, F.concat(F.lit(base), b).alias("url"),
                         F.concat(F.lit(base), F.url_encode(b)).alias("url_encoded"))


def read_landed_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED_PAGES).parquet(path)


def read_landed_html(spark: SparkSession, root: str) -> DataFrame:
    """One row per HTML file under ``root`` (whole file as one value); id from the file path.

    A crawler landing pages as ``<root>/brand=<name>/<file>.html`` gets the
    brand from Spark's partition discovery (values unescaped by Spark);
    without such folders ``brand`` is NULL. ``captured_at`` is the file
    modification time.
    """
    raw = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", False).load(root)
    brand = F.col("brand").cast("string") if "brand" in raw.columns else F.lit(None).cast(T.StringType())
    return raw.select(F.xxhash64(F.col("_metadata.file_path")).alias("page_id"),
                      F.col("_metadata.file_path").alias("url"), brand.alias("brand"),
                      F.lit(None).cast(T.StringType()).alias("location"),
                      F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("captured_at"),
                      F.col("value").alias("html"))


POSITION_KEYS = ("page_id", "pos_in_pg")


def save_position_table(df: DataFrame, table: str, path: str, buckets: int,
                        keys: tuple[str, ...] = POSITION_KEYS, mode: str = "overwrite") -> None:
    """Land a table keyed by page position (descriptions, say) bucketed by that key.

    Written to ``path`` (shared storage) and registered as ``table``. The
    daily run's attach join then reads it already partitioned by the join key:
    its rows, description text included, are never shuffled. Use as many
    buckets as the shuffle partitions of the join (or more).
    """
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def read_position_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
