"""The training-corpus pipeline: language ID, SimHash near-dedup, benchmark
decontamination, personal-data redaction, source mixing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of documents. ``run`` applies them to the documents
table, each written as Parquet to the shared folder and read back.

What the stages do with rows: language ID drops documents without a letter and
documents that no learned language explains better than plain letter
frequencies; near-dedup keeps of each component the row with the smallest
(doc_id, text); decontamination drops documents that hold a benchmark window;
redaction keeps every row and replaces personal data in its text; mixing returns
document copies with their epoch, block and order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import decontam, langid, mixing, pii, simhash
from shelfwise.llm.catalog import MIX_MAX_EPOCHS
from shelfwise.llm.common import table, written

# DuckDB SQL cannot express the learned stages; the stages are tested against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that some label names, learned from every labelled document; NULL and letterless texts go.
    No label at all keeps every text with a letter."""
    model = langid.train(docs)
    if not model:
        return docs.filter(langid.has_letter(F.col("text")))
    rows = docs.select(F.struct("*").alias("__row"), "text")
    return langid.predict(rows, model, keep=["__row"]).filter("known").select("__row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest (doc_id, text hash); NULL ids come last."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    d = docs.withColumn("__key", key)
    found = simhash.near_duplicates(d.select("__key", "text"), id_col="__key", shingle_words=simhash.SHINGLE_WORDS,
                                    radius=simhash.RADIUS)
    first = found.filter(F.col("__key") == F.col("component_id")).select("__key").distinct()
    # rows equal in id and text are one document; of their other columns those of the smallest hash stay
    rank = F.xxhash64(*[f.name for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)])
    return d.join(first, "__key", "left_semi").groupBy("__key") \
        .agg(F.min_by(F.struct(*docs.columns), rank).alias("__row")).select("__row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by tags; n_chars follows the text."""
    out = pii.redact(docs, pii.train(docs))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document copies with mix_epoch, mix_block, mix_order, mix_weight."""
    return mixing.mix(docs, max_epochs=MIX_MAX_EPOCHS)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("personal_data", personal_data), ("source_mixing", source_mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
