"""Global position: the row number over a whole table without a single-task window.

Rows are dealt out by ranges of the order, sorted inside their partition and
written with their place in it (the recovery point, and what makes the two reads
below agree); the counts per partition, one number each, give every partition its
offset. A key shared by any number of rows is cut like all others: rows equal in
the whole order are told apart by where they were read.
"""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

ROW_BITS = 33          # of monotonically_increasing_id: the row in its partition


def numbered(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """``df`` with BIGINT ``name``: the 1-based position of each row under ``order``.

    Rows equal in ``order`` are numbered in the order they were read. An empty
    table gives an empty result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"numbered-{uuid.uuid4().hex}")
    keys = [F.col(c) if isinstance(c, str) else c for c in order] + [F.col("__read")]
    place = df.withColumn("__read", F.monotonically_increasing_id()) \
        .repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .withColumn("__part", F.spark_partition_id()) \
        .withColumn("__row", F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1)).drop("__read")
    place.write.parquet(path)
    rows = spark.read.schema(place.schema).parquet(path)
    counts = sorted(rows.groupBy("__part").count().collect())            # one row per partition
    before = [0, *accumulate(r["count"] for r in counts)]
    offsets = spark.createDataFrame([(r["__part"], b) for r, b in zip(counts, before)], "__part int, __before bigint")
    return rows.join(F.broadcast(offsets), "__part") \
        .withColumn(name, F.col("__before") + F.col("__row") + 1).select(*df.columns, name)
