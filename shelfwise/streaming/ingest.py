"""Streaming ingest of landed pages (our addition; the runs themselves are batch).

Pages landing continuously in a folder are turned into card rows by the same
extraction as the batch run, with Structured Streaming: a file source with a
declared schema, the stateless card extraction, and a Parquet sink whose
checkpoint lives in the cluster's shared checkpoint folder. The extraction is
row-local (no state, no watermark needed), so ``trigger(availableNow=True)``
processes everything landed so far and stops, exactly-once through the
checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.daily import SEARCH_CARD, search_cards
from ..schemas import LANDED_PAGES
from ..session import scratch_path


def landed_stream(spark: SparkSession, landed_dir: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(LANDED_PAGES).option("maxFilesPerTrigger", max_files).parquet(landed_dir)


def card_stream(spark: SparkSession, landed_dir: str, card: tuple[str, str] = SEARCH_CARD,
                fields: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    return search_cards(landed_stream(spark, landed_dir), card, fields)


def start_card_ingest(spark: SparkSession, landed_dir: str, out_dir: str, name: str = "card_ingest",
                      checkpoint: str | None = None, card: tuple[str, str] = SEARCH_CARD,
                      fields: dict[str, tuple[str, str]] | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Start the ingest; the caller awaits it (``awaitTermination``) or stops it."""
    ckpt = checkpoint or scratch_path(spark, f"streams/{name}")
    w = card_stream(spark, landed_dir, card, fields).writeStream.format("parquet") \
        .option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_dir)
