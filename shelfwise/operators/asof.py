"""As-of join: to every left row the latest right row of its key that is not later.

A union of both sides is cut into time buckets; inside a (key, bucket) group a
window carries the latest right row forward. What a bucket has none for comes from
before it: each bucket's last right row is one summary, carried across buckets
within ranges of ``fan`` buckets and then across those ranges. No group holds a
key's whole history, so a hot key is spread over its time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timefmt as TF

BUCKET_SECONDS = 3600
FAN = 1024


def _before(asks: DataFrame, has: DataFrame, by: list[str], at: str) -> DataFrame:
    """``asks`` (by, at) with ``__got``: the last ``__last`` of ``has`` strictly before ``at``."""
    rows = asks.withColumn("__last", F.lit(None).cast(has.schema["__last"].dataType)).withColumn("__side", F.lit(0)) \
        .unionByName(has.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("__got", F.last("__last", ignorenulls=True).over(w)).filter("__side = 0").drop("__last", "__side")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], bucket_seconds: int = BUCKET_SECONDS, fan: int = FAN) -> DataFrame:
    """``left`` with the columns ``values`` of the latest ``right`` row of equal ``by`` and ``right_time <= left_time``.

    NULL where there is none, and for left rows with a NULL key or time; every left
    row stays, once. Of right rows with one key and time the one with the greatest
    values counts. Keep the left side narrow: its rows are shuffled. Times are
    TIMESTAMP_NTZ; one (key, bucket) group holds the rows of a key in
    ``bucket_seconds``.
    """
    by, values = list(by), list(values)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def bucket(t: Column) -> Column:
        return F.floor(TF.span_seconds(epoch, t) / bucket_seconds)

    row = F.struct(*[F.col(c) for c in left.columns])
    keyed = F.col(left_time).isNotNull()
    for c in by:
        keyed = keyed & F.col(c).isNotNull()
    value = F.struct(*[F.col(c) for c in values])
    lt = left.filter(keyed).select(*by, F.col(left_time).alias("__t"), F.lit(1).alias("__side"), row.alias("__row"))
    rt = right.filter(F.col(right_time).isNotNull()) \
        .select(*by, F.col(right_time).alias("__t"), F.lit(0).alias("__side"), value.alias("__value"))
    rows = lt.unionByName(rt, allowMissingColumns=True).withColumn("__bucket", bucket(F.col("__t")))
    w = Window.partitionBy(*by, "__bucket").orderBy("__t", "__side", "__value").rowsBetween(Window.unboundedPreceding, 0)
    near = rows.withColumn("__value", F.last("__value", ignorenulls=True).over(w)).filter("__side = 1")
    last = rt.withColumn("__bucket", bucket(F.col("__t"))).groupBy(*by, "__bucket") \
        .agg(F.max(F.struct("__t", "__value")).alias("__m")).select(*by, "__bucket", F.col("__m.__value").alias("__last"))
    ask = near.filter(F.col("__value").isNull()).select(*by, "__bucket").distinct()
    part = F.floor(F.col("__bucket") / fan).alias("__part")
    has = last.select("*", part)
    inside = _before(ask.select("*", part), has, [*by, "__part"], "__bucket")
    ends = has.groupBy(*by, "__part").agg(F.max_by("__last", "__bucket").alias("__last"))
    beyond = _before(inside.filter(F.col("__got").isNull()).select(*by, "__part").distinct(), ends, by, "__part")
    carried = inside.join(beyond.withColumnRenamed("__got", "__far"), [*by, "__part"], "left") \
        .select(*by, "__bucket", F.coalesce("__got", "__far").alias("__got"))
    found = near.join(carried, [*by, "__bucket"], "left").select("__row", F.coalesce("__value", "__got").alias("__value"))
    out = found.select("__row.*", *[F.col(f"__value.{c}").alias(c) for c in values])
    rest = left.filter(~F.coalesce(keyed, F.lit(False)))
    return out.unionByName(rest.withColumns({c: F.lit(None).cast(right.schema[c].dataType) for c in values}))
