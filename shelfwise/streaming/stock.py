"""The stock fold as observations arrive (Structured Streaming, keyed state).

Every product key holds a state of fixed size: the last step folded, whether the
fold has stopped or failed, and the last parsed number. A micro-batch's rows of a
key are folded in step order onto it. The result equals the batch fold
(``operators.stock``) when a key's steps land in order from batch to batch, in any
order inside one; a row whose step is not after the last one folded comes too late: it
is counted in ``n_late`` and changes nothing.

Each micro-batch is written as a run of its own name, so a batch that Spark repeats
after a failure replaces its own rows and none are doubled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import stock as batch
from ..schemas import STOCK_OBSERVATIONS
from ..sources import runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "last_step bigint, ended boolean, failed boolean, val bigint, n_late bigint"
READING = "stock bigint, last_step bigint, n_late bigint"


def fold(state: tuple, rows: list[tuple]) -> tuple:
    """``state`` after ``rows`` (step, parsed or None, is_stop, fail), which are in step order."""
    last, ended, failed, val, late = state
    for step, parsed, is_stop, fail in rows:
        if last is not None and step <= last:
            late += 1
            continue
        last = step
        if not ended:
            failed = bool(fail)
            val = parsed if parsed is not None else val
            ended = failed or bool(is_stop)
    return last, ended, failed, val, late


def stock_stream(obs: DataFrame, keys: Sequence[str] = ("page_id", "pos_in_pg"), **columns) -> DataFrame:
    """Keys with ``stock`` (BIGINT, NULL when collection failed), ``last_step`` and ``n_late``, whenever a key changes."""
    keys = list(keys)
    flags = batch.observation_flags(obs, keys, **columns)        # texts are parsed in the JVM

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = []
        for f in frames:
            parsed = [None if pd.isna(v) else int(v) for v in f["parsed"]]
            rows += zip(f["step"].tolist(), parsed, f["is_stop"].tolist(), f["fail"].tolist(), strict=True)
        new = fold(state.get if state.exists else (None, False, False, None, 0), sorted(rows, key=lambda r: r[0]))
        state.update(new)
        last, _, failed, val, late = new
        stock = None if failed else 0 if val is None else val
        yield pd.DataFrame({**{k: [v] for k, v in zip(keys, key, strict=True)},
                            "stock": pd.array([stock], dtype="Int64"), "last_step": [last], "n_late": [late]})

    key_fields = ", ".join(f"`{k}` {flags.schema[k].dataType.simpleString()}" for k in keys)
    return flags.groupBy(*keys).applyInPandasWithState(
        update, f"{key_fields}, {READING}", STATE, "update", GroupStateTimeout.NoTimeout)


def start_stock_fold(spark: SparkSession, landed: str, table: str, checkpoint: str,
                     files_per_trigger: int | None = None) -> StreamingQuery:
    """Fold observation files (Parquet) as they land, up to those there now; readings go to the table of runs ``table``."""
    source = spark.readStream.schema(STOCK_OBSERVATIONS)
    if files_per_trigger:
        source = source.option("maxFilesPerTrigger", files_per_trigger)

    def write(readings: DataFrame, number: int) -> None:
        runs.write_run(readings, table, f"batch-{number}")

    return stock_stream(source.parquet(landed)).writeStream.outputMode("update").foreachBatch(write) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_stock(spark: SparkSession, table: str) -> DataFrame:
    """The newest reading of every key: page_id, pos_in_pg, stock, last_step, n_late."""
    schema = T.StructType([*STOCK_OBSERVATIONS.fields[:2], *T.StructType.fromDDL(READING).fields])
    rows = runs.read_runs(spark, table, schema)
    newest = F.max_by(F.struct("stock", "last_step", "n_late"), F.struct("last_step", "n_late"))
    return rows.groupBy("page_id", "pos_in_pg").agg(newest.alias("r")).select("page_id", "pos_in_pg", "r.*")
