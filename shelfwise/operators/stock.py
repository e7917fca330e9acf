"""Units in stock from add-to-bag observations.

An observation table holds, per product key and step (in click order): the
bag text read at that step, whether the limit marker was shown, whether the
bag counter was still there, and whether the step failed. The fold, per key:

* a step that failed aborts the product: stock is NULL (collection failed);
* otherwise the bag text is parsed (first token, commas removed, integer);
* a parsed number together with the limit marker stops the fold;
* otherwise a missing bag counter stops the fold;
* stock is the last parsed number up to the stop, 0 when none was parsed.

Steps after the stop do not count, failures after it neither. NULL flags
read as "not seen". Stock has three states: n, 0 (could not be added), NULL.

The fold is order-dependent, so one grouped aggregate cannot compute it, and a
window per key would hold a hot key (a third of all rows) in one task.
Instead each key's steps are cut into buckets of ``bucket_steps`` consecutive
step numbers. A (key, bucket) group holds at most that many rows whatever the
key's size, so the shuffle spreads a hot key over many tasks. Each bucket is
folded into a fixed-size summary (window + aggregate on the same
partitioning, one shuffle). Summaries of contiguous step ranges merge exactly
into the summary of their union, so they are merged ``merge_fanin`` at a time
(bounded groups again) and finally once per key; every group any task holds
is bounded, even when steps are sparse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import first_token, units

# Consecutive step numbers per bucket: bounds the rows of one (key, bucket) group.
BUCKET_STEPS = 1 << 16
# Bucket summaries merged per level, and levels before the final per-key merge.
MERGE_FANIN = 1 << 10
MERGE_LEVELS = 1
# Step types of so small a range that a key has at most 2 ** 16 buckets.
SMALL_STEPS = (T.IntegerType, T.ShortType, T.ByteType)


def observation_flags(obs: DataFrame, keys: Sequence[str], step: str = "step",
                      bag_text: str = "bag_text", limit: str = "limit_marker",
                      counter: str = "counter_present", failed: str = "failed",
                      time_col: str | None = None, keep_text: bool = False) -> DataFrame:
    """Per observation: parsed units (``keep_text``: also their text) and the stop / failure flags.

    ``parsed`` is its own projection so the regex runs once per row (the
    optimizer does not inline a non-cheap expression used twice).
    """
    p = obs.select(*keys, F.col(step).cast("bigint").alias("step"), units(bag_text).alias("parsed"),
                   F.coalesce(F.col(limit), F.lit(False)).alias("lim"),
                   F.coalesce(F.col(counter), F.lit(False)).alias("ctr"),
                   F.coalesce(F.col(failed), F.lit(False)).alias("fail"),
                   *([F.col(time_col).alias("seen_at")] if time_col else []),
                   *([first_token(bag_text).alias("tok")] if keep_text else []))
    stop = (F.col("parsed").isNotNull() & F.col("lim")) | ~F.col("ctr")
    return p.select(*keys, "step", "parsed", stop.alias("is_stop"), "fail",
                    *(["seen_at"] if time_col else []), *(["tok"] if keep_text else []))


def bucket_summaries(flags: DataFrame, keys: Sequence[str], bucket_steps: int = BUCKET_STEPS) -> DataFrame:
    """One row per (key, bucket): first stop, first failure, last parsed up to the
    bucket's first stop, and last parsed overall (value and step)."""
    keys = list(keys)
    b = flags.withColumn("seg", F.expr(f"step div {int(bucket_steps)}"))
    w = Window.partitionBy(*keys, "seg").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("stop_before", F.coalesce(F.max("is_stop").over(w), F.lit(False)))
    parsed = F.col("parsed").isNotNull()
    upto = parsed & ~F.col("stop_before")
    extra = []
    if "seen_at" in flags.columns:
        # (step, time) of the first stop, the first failure and the last observation with a time
        at = F.struct("step", "seen_at")
        extra = [F.min(F.when(F.col("is_stop"), at)).alias("stop_at"), F.min(F.when(F.col("fail"), at)).alias("fail_at"),
                 F.max(F.when(F.col("seen_at").isNotNull(), at)).alias("end_at")]
    if "tok" in flags.columns:
        extra += [F.max_by(F.when(upto, F.col("tok")), F.when(upto, F.col("step"))).alias("upto_tok"),
                  F.max_by(F.when(parsed, F.col("tok")), F.when(parsed, F.col("step"))).alias("last_tok")]
    return b.groupBy(*keys, "seg").agg(
        *extra,
        F.min(F.when(F.col("is_stop"), F.col("step"))).alias("first_stop"),
        F.min(F.when(F.col("fail"), F.col("step"))).alias("first_fail"),
        F.max(F.when(upto, F.col("step"))).alias("upto_step"),
        F.max_by(F.when(upto, F.col("parsed")), F.when(upto, F.col("step"))).alias("upto_val"),
        F.max(F.when(parsed, F.col("step"))).alias("last_step"),
        F.max_by(F.when(parsed, F.col("parsed")), F.when(parsed, F.col("step"))).alias("last_val"))


def merge_segments(segs: DataFrame, group: Sequence[str]) -> DataFrame:
    """Merge the summaries of contiguous segments within each ``group`` into one summary.

    S = first stop of the group. The merged "up to first stop" value is the
    last parsed step at or before S: from the segment holding S its own value,
    from segments without a stop that end before S their last value. The
    window holds the segments of one group only.
    """
    group = list(group)
    segs = segs.withColumn("S", F.min("first_stop").over(Window.partitionBy(*group)))
    in_stop_seg = F.col("first_stop") == F.col("S")
    before_stop = F.col("first_stop").isNull() & (F.col("S").isNull() | (F.col("last_step") < F.col("S")))
    cand_step = F.when(in_stop_seg, F.col("upto_step")).when(before_stop, F.col("last_step"))
    cand_val = F.when(in_stop_seg, F.col("upto_val")).when(before_stop, F.col("last_val"))
    extra = [F.min("stop_at").alias("stop_at"), F.min("fail_at").alias("fail_at"),
             F.max("end_at").alias("end_at")] if "end_at" in segs.columns else []
    if "upto_tok" in segs.columns:
        tok = F.when(in_stop_seg, F.col("upto_tok")).when(before_stop, F.col("last_tok"))
        extra += [F.max_by(tok, cand_step).alias("upto_tok"), F.max_by("last_tok", "last_step").alias("last_tok")]
    return segs.groupBy(*group).agg(
        *extra,
        F.min("first_stop").alias("first_stop"),
        F.min("first_fail").alias("first_fail"),
        F.max(cand_step).alias("upto_step"),
        F.max_by(cand_val, cand_step).alias("upto_val"),
        F.max("last_step").alias("last_step"),
        F.max_by("last_val", "last_step").alias("last_val"))


def stock_from_summary(summary: DataFrame, keys: Sequence[str], out: str = "stock") -> DataFrame:
    """Stock from the one summary per key: NULL when a failure came at or before the first stop."""
    f, s = F.col("first_fail"), F.col("first_stop")
    failed_before_stop = f.isNotNull() & (s.isNull() | (f <= s))
    stock = F.when(failed_before_stop, F.lit(None).cast("bigint")).otherwise(F.coalesce("upto_val", F.lit(0)))
    # the reading ends at the failure or the stop, else with the last observation
    ended = F.when(failed_before_stop, F.col("fail_at.seen_at")).when(s.isNotNull(), F.col("stop_at.seen_at")) \
        .otherwise(F.col("end_at.seen_at")) if "end_at" in summary.columns else None
    text = [F.when(~failed_before_stop, F.coalesce("upto_tok", F.lit("0"))).alias(f"{out}_text")] \
        if "upto_tok" in summary.columns else []
    return summary.select(*keys, stock.cast("bigint").alias(out), *([ended.alias("seen_at")] if ended is not None else []),
                          *text)


def fold_stock(obs: DataFrame, keys: Sequence[str] = ("page_id", "pos_in_pg"), step: str = "step",
               bag_text: str = "bag_text", limit: str = "limit_marker",
               counter: str = "counter_present", failed: str = "failed",
               out: str = "stock", bucket_steps: int = BUCKET_STEPS, merge_levels: int | None = None,
               merge_fanin: int = MERGE_FANIN, time_col: str | None = None, keep_text: bool = False) -> DataFrame:
    """One row per key: ``keys`` + ``out`` (BIGINT, NULL when collection failed).

    With ``time_col`` also ``seen_at``: the time at which the reading ended, that is of
    the first stop or of a failure before it (NULL when that step has no time), else of
    the last observation with a time; merged in the same aggregates. With ``keep_text``
    also ``<out>_text``: the first token of the text that gave the stock, as written (``0`` if none did).
    Buckets of ``bucket_steps`` steps are merged ``merge_fanin`` at a time for
    ``merge_levels`` levels, then once per key: the last merge holds at most
    (step range of a key) / (bucket_steps * merge_fanin ** merge_levels)
    summaries of one key. By default steps of a type of four bytes or less, whose range is
    itself bounded, need no level before the last merge (one exchange less).
    """
    keys = list(keys)
    if merge_levels is None:
        merge_levels = 0 if isinstance(obs.schema[step].dataType, SMALL_STEPS) else MERGE_LEVELS
    flags = observation_flags(obs, keys, step, bag_text, limit, counter, failed, time_col, keep_text)
    segs = bucket_summaries(flags, keys, bucket_steps)
    for _ in range(merge_levels):
        segs = merge_segments(segs.withColumn("seg", F.expr(f"seg div {int(merge_fanin)}")), keys + ["seg"])
    return stock_from_summary(merge_segments(segs, keys), keys, out)
